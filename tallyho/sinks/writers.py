"""Report and log sinks (K1-K8).

Spreadsheet workbooks become one dataset per report table; a run is a partition
``run_ts=<yyyyMMdd_HHmmss>`` (K5), so outputs of different runs sit side by side and
readers prune to the run they want.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def run_stamp(now: _dt.datetime | None = None, seconds: bool = True) -> str:
    """K5: run label ``yyyyMMdd_HHmmss`` (or ``yyyyMMdd_HHmm``)."""
    now = now or _dt.datetime.now()
    return now.strftime("%Y%m%d_%H%M%S" if seconds else "%Y%m%d_%H%M")


def write_report(tables: dict[str, DataFrame], root: str, run_ts: str | None = None,
                 fmt: str = "parquet", skip_empty: tuple[str, ...] = (),
                 partition_by: dict[str, list[str]] | None = None) -> dict[str, str]:
    """K1-K4: write every table of a report under ``root/<table>/run_ts=<run>/``.

    An empty table is still written (Spark keeps its schema) unless its name is in
    ``skip_empty`` -- the consolidation report only writes ERRORS when there are any.
    ``partition_by`` adds partition columns per table (K4: one vendor table, a folder per term).
    """
    run_ts = run_ts or run_stamp()
    paths = {}
    for name, df in tables.items():
        if name in skip_empty and df.isEmpty():
            continue
        path = os.path.join(root, name)
        parts = ["run_ts", *((partition_by or {}).get(name, []))]
        # dynamic partition overwrite: a re-run of the same run replaces its own partitions
        # (idempotent after a failure) and leaves every other run untouched
        (df.withColumn("run_ts", F.lit(run_ts)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts).format(fmt).save(path))
        paths[name] = path
    return paths


def write_tsv(df: DataFrame, path: str, null_text: str = "None") -> None:
    """K6: headerless tab-separated text, replacing the previous extract."""
    (df.write.mode("overwrite").option("sep", "\t").option("header", False)
     .option("nullValue", null_text).csv(path))


def append_run_log(spark: SparkSession, path: str, message: str, level: str = "INFO",
                   rows: int | None = None) -> None:
    """K8: one line ``[ts] message`` appended to the run-log table."""
    df = spark.createDataFrame([(level, message, rows)], "level string, message string, rows long")
    df.withColumn("ts", F.current_timestamp()).write.mode("append").parquet(path)


def format_log_lines(log: DataFrame) -> DataFrame:
    """K8 text form: ``[yyyy-MM-dd HH:mm:ss] message``."""
    return log.select(F.concat(F.lit("["), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("] "),
                               F.col("message")).alias("line"))
