"""Sensor readings: parse device replies into (ts, rh, temp) rows, route bad replies to a
reject table, summarise, derive the dew point.  Batch and streaming share these
functions (see ``streaming.readings``)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.dates import log_timestamp
from ..functions.replies import dew_point, field_number, reply_field, reply_parts


def parse_replies(replies: DataFrame, raw: str = "raw", variant: str = "A") -> DataFrame:
    """F7/F8 + R2: every reply with its fields, numbers and a reject reason (null = good)."""
    staged = replies.withColumn("_tly_f", reply_parts(raw, variant))
    f = F.col("_tly_f")
    rh = field_number(f, config.REPLY_RH_FIELD)
    temp = field_number(f, config.REPLY_TEMP_FIELD)
    reason = (F.when(F.size(f) < config.REPLY_MIN_FIELDS, F.lit("too few fields"))
              .when(rh.isNull() | temp.isNull(), F.lit("not a number")))
    parsed = (staged.withColumns({
        "rh": rh, "temp_c": temp,
        "rh_unit": reply_field(f, config.REPLY_RH_FIELD + 1),
        "trend": reply_field(f, config.REPLY_TREND_FIELD),
        "temp_unit": reply_field(f, config.REPLY_TEMP_FIELD + 1),
        "reject_reason": reason})
        .drop("_tly_f"))
    # R2: good / rejected counts are published with the query (also per micro-batch in a
    # stream's progress); the node keeps the reject filter from re-parsing in the scan
    bad = F.col("reject_reason").isNotNull()
    return parsed.observe(f"reply_parse_{uuid.uuid4().hex[:8]}", F.count(F.lit(1)).alias("replies"),
                          F.count_if(bad).alias("rejected"))


def good(parsed: DataFrame, keep=("event_id", "ts")) -> DataFrame:
    return (parsed.where(F.col("reject_reason").isNull())
            .select(*keep, "rh", "temp_c", "rh_unit", "trend", "temp_unit"))


def rejected(parsed: DataFrame, keep=("event_id", "ts"), raw: str = "raw") -> DataFrame:
    return parsed.where(F.col("reject_reason").isNotNull()).select(*keep, raw, "reject_reason")


def in_range(readings: DataFrame, start=None, end=None, ts: str = "ts") -> DataFrame:
    """Readings with ``start <= ts < end`` (either bound optional)."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        cond = cond & (F.col(ts) < F.lit(end).cast("timestamp_ntz"))
    return readings.where(cond)


def stats(readings: DataFrame, unit: str = "day", ts: str = "ts") -> DataFrame:
    """Count, mean, min and max of RH and temperature per time bucket.

    Sums are exact decimals (three decimals, as the device prints them), so the means
    do not depend on the order rows are added in.
    """
    bucket = (F.to_date(F.col(ts)) if unit == "day"
              else F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz")).alias(unit)
    n = F.count(F.lit(1))

    def mean(c):
        # ANSI-safe: an outlier that does not fit, or a sum that overflows, gives null
        # instead of failing the job
        return (F.try_sum(F.col(c).try_cast("decimal(38,3)")).cast("double") / n).alias(f"{c}_avg")
    return (readings.groupBy(bucket)
            .agg(n.alias("n"), mean("rh"), F.min("rh").alias("rh_min"), F.max("rh").alias("rh_max"),
                 mean("temp_c"), F.min("temp_c").alias("temp_c_min"), F.max("temp_c").alias("temp_c_max")))


def partial_stats(readings: DataFrame, unit: str = "hour", ts: str = "ts") -> DataFrame:
    """A12 in parts: what ``merge_stats`` needs of some of the readings, a row a bucket."""
    bucket = F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz").alias("bucket")
    parts = [f(c, k) for c in ("rh", "temp_c") for k, f in _PARTS.items()]
    return readings.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"), *parts)


_PARTS = {
    "sum": lambda c, k: F.try_sum(F.col(c).try_cast("decimal(38,3)")).alias(f"{c}_{k}"),
    "min": lambda c, k: F.min(c).alias(f"{c}_{k}"),
    "max": lambda c, k: F.max(c).alias(f"{c}_{k}"),
}


def merge_stats(parts: DataFrame, *by: str) -> DataFrame:
    """A12 from parts: sums are exact decimals, so any split of the readings gives the same means."""
    n = F.sum("n")
    out = [n.alias("n")]
    for c in ("rh", "temp_c"):
        out += [(F.try_sum(f"{c}_sum").cast("double") / n).alias(f"{c}_avg"),
                F.min(f"{c}_min").alias(f"{c}_min"), F.max(f"{c}_max").alias(f"{c}_max")]
    return parts.groupBy(*by).agg(*out)


def with_dew_point(readings: DataFrame) -> DataFrame:
    """Dew point rounded to 4 decimals."""
    return readings.withColumn("dew_point_c", F.round(dew_point("rh", "temp_c"), 4))


def parse_log_lines(log: DataFrame, ts_text: str = "timestamp", keep=()) -> DataFrame:
    """S8 + D10: a sensor CSV log (minute or second timestamps) as typed readings."""
    return log.select(*keep, log_timestamp(F.col(ts_text)).alias("ts"),
                      F.col("`humidity_%RH`").cast("double").alias("rh"),
                      F.col("temperature_C").cast("double").alias("temp_c"))
