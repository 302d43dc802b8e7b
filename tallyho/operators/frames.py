"""Register frames: decode replies, check CRCs, build requests, probe coverage.

Every operator is a projection (plus ``explode`` for one row per register) or one
aggregate; the byte work is in ``functions.registers``.
"""

from __future__ import annotations

import uuid

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import registers as R

STATUS_OK = "ok"
STATUS_SHORT = "short"
STATUS_EXCEPTION = "exception"
STATUS_BAD_CRC = "bad_crc"


def decode_replies(frames: DataFrame, frame_col: str = "frame", keep=("event_id",)) -> DataFrame:
    """M4 + M8 + M9: one row per captured reply with its header fields and status.

    A reply needs ``byte_count + 5`` bytes (address, function, count, data, CRC); an
    exception reply (function code with the high bit) carries an exception code instead
    of data.  Registers are only decoded for complete replies with a valid CRC.
    """
    # staged projections: bytes once, then header fields and the CRC check, then status
    staged = frames.select(*keep, R.byte_array(F.col(frame_col)).alias("_tly_b"))
    arr = F.col("_tly_b")
    staged = staged.select(*keep, "_tly_b", F.size(arr).alias("_tly_n"), R.at(arr, 1).alias("address"),
                           R.at(arr, 2).alias("function"), R.at(arr, 3).alias("_tly_cnt"),
                           R.crc_ok_bytes(arr).alias("_tly_crc_ok"))
    n, function, count = F.col("_tly_n"), F.col("function"), F.col("_tly_cnt")
    status = (F.when(n < 3, STATUS_SHORT)
              .when(R.is_exception(function), STATUS_EXCEPTION)
              .when(n < count + 5, STATUS_SHORT)
              .when(~F.col("_tly_crc_ok"), STATUS_BAD_CRC)
              .otherwise(STATUS_OK))
    decoded = staged.select(
        *keep, "address", "function",
        F.when(~R.is_exception(function), count).alias("byte_count"),
        status.alias("status"),
        F.when(R.is_exception(function), count).alias("exception_code"),
        "_tly_b")
    decoded = decoded.withColumn("registers", F.when(F.col("status") == STATUS_OK, R.reply_registers(arr))).drop("_tly_b")
    # per-status counters ride along; the node also keeps status filters from being
    # pushed below (and re-inlining) the byte-level expressions
    s = F.col("status")
    return decoded.observe(f"frame_decode_{uuid.uuid4().hex[:8]}", F.count(F.lit(1)).alias("frames"),
                           F.count_if(s == STATUS_OK).alias("ok"), F.count_if(s == STATUS_SHORT).alias("short"),
                           F.count_if(s == STATUS_EXCEPTION).alias("exception"),
                           F.count_if(s == STATUS_BAD_CRC).alias("bad_crc"))


def registers_long(replies: DataFrame, keep=("event_id",)) -> DataFrame:
    """M4 + M5 + F13: one row per register of every good reply."""
    return (replies.where(F.col("status") == STATUS_OK)
            .select(*keep, "address", F.posexplode("registers").alias("pos", "value"))
            .select(*keep, "address", (F.col("pos") + 1).alias("reg_index"), "value",
                    R.hex_word(F.col("value")).alias("value_hex"),
                    R.scaled_int(F.col("value")).alias("scaled_int"),
                    R.scaled(F.col("value")).alias("scaled")))


def requests(units: DataFrame, function_col: str = "function", start_col: str = "start",
             count_col: str = "count", address_col: str = "address") -> DataFrame:
    """M3: the 8-byte read request (with CRC) for every row of a request table."""
    frame = R.read_request(F.col(address_col), F.col(function_col), F.col(start_col), F.col(count_col))
    return units.withColumn("request", frame).withColumn("request_hex", F.hex(F.col("request")))


def register_blocks(replies: DataFrame, windows: DataFrame, keep=("event_id",)) -> DataFrame:
    """M6 + M7 + O6: register blocks with their logical address range, the first eight
    words and the word-swapped float of the first two words.

    ``windows`` gives per reply the register start address (``event_id, start``).
    """
    ok = replies.where(F.col("status") == STATUS_OK).join(windows, list(keep))
    base = F.when(F.col("function") == config.FUNCTION_BY_BASE["3x"], F.lit("3x")).otherwise(F.lit("4x"))
    regs = F.col("registers")
    first = R.logical_address(base, F.col("start"))
    return ok.select(
        *keep, F.col("address").alias("unit"), base.alias("base"),
        first.alias("address_from"), (first + F.size(regs) - 1).alias("address_to"),
        F.array_join(F.slice(regs, 1, config.READ_PREFIX_REGISTERS), " ").alias("words"),
        F.when(F.size(regs) >= 2, R.float_from_words(R.at(regs, 2), R.at(regs, 1)))
        .alias("float_swapped"))


def probe_grid(spark) -> DataFrame:
    """The probe's search grid: units x register bases x windows (fixed, 24 rows)."""
    rows = [(u, b, s, n) for u, b, (s, n) in itertools.product(config.PROBE_UNITS, config.PROBE_BASES,
                                                                config.PROBE_WINDOWS)]
    return spark.createDataFrame(rows, "unit int, base string, start int, length int")


def probe_coverage(blocks: DataFrame) -> DataFrame:
    """J9 (re-aimed): which grid cells answered, from captured replies instead of live
    network probing.  Captured reads are aggregated first, then left-joined to the grid
    (a broadcast of the fixed 24-row grid; no cross product of data)."""
    grid = probe_grid(blocks.sparkSession)
    start = F.col("address_from") - F.when(F.col("base") == "3x", F.lit(config.REGISTER_BASE_INPUT)) \
        .otherwise(F.lit(config.REGISTER_BASE_HOLDING))
    reads = (blocks.select(F.col("unit").cast("int").alias("unit"), "base", start.cast("int").alias("start"))
             .groupBy("unit", "base", "start").agg(F.count(F.lit(1)).alias("reads")))
    first = R.logical_address(F.col("base"), F.col("start"))
    return (F.broadcast(grid).join(reads, ["unit", "base", "start"], "left")
            .select("unit", "base", "start", "length", first.alias("address_from"),
                    (first + F.col("length") - 1).alias("address_to"),
                    F.coalesce(F.col("reads"), F.lit(0)).cast("long").alias("reads"),
                    F.col("reads").isNotNull().alias("hit")))
