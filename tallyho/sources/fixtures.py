"""Inputs in the shape the voucher and sensor jobs expect, derived from the data set tables.

The data set has no spreadsheets, sensor replies or register frames, so each input is a
view over a real table (see FIXTURES.md): a voucher table over ``orders`` joined with
``customer``, two versions of a ``lineitem`` projection for the diff, a long-form cell grid
over ``customer`` and ``nation``, and device replies / register frames over ``events``.
All of them scale with the tables they come from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import day_of_month
from ..operators.skew import occurrence_number, occurrence_number_unique
from .tables import read_table

# ---- fixed values: payment-term texts cycled over the orders ------------------------
VOUCHER_TERMS = [
    "當月15號", "當月18號付款", "次月15號付款", "月結18天", "月結48天", "月結78天",
    "月結30天", "月結60天", "月結120天", "月結90天", "請財務部確認付款日",
]
OVERRIDE_VENDOR_EVERY = 50


def folder_vouchers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vouchers with a folder: the region of the vendor's customer."""
    c = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("_code"), "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("folder"))
    v = vouchers(spark, sf_dir)
    return (v.join(c, v.vendor_code == F.col("_code")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(*v.columns, "folder"))


def vouchers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Voucher table: one row per order, vendor from the customer, a cycled payment term
    (every 12th order has none) and a recorded payment date (every 5th order has none)."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    d = F.col("o_orderdate").cast("date")
    k = F.col("o_orderkey")
    term = F.try_element_at(F.array(*[F.lit(t) for t in VOUCHER_TERMS]), (k % 12 + 1).cast("int"))
    planned = (F.when(k % 5 == 1, day_of_month(d, 1, 18))
               .when(k % 5 == 2, day_of_month(d, 0, 15))
               .when(k % 5 == 3, F.last_day(F.add_months(d, 1)))
               .when(k % 5 == 4, F.date_add(d, 30)))
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select(F.concat(F.lit("V"), k.cast("string")).alias("voucher_no"),
                    d.alias("doc_date"),
                    F.col("o_custkey").cast("string").alias("vendor_code"),
                    F.when(F.col("o_custkey") % OVERRIDE_VENDOR_EVERY == 0, F.lit("南科管理局"))
                     .otherwise(F.col("c_name")).alias("vendor_name"),
                    F.when(k % 12 != 11, term).alias("term_name"),
                    planned.alias("planned_pay_date"),
                    F.col("o_totalprice").cast("decimal(18,2)").alias("amount")))


DIFF_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate"]
DIFF_KEYS = ["l_orderkey", "l_linenumber"]


def diff_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.where(F.col("l_partkey") % 10 != 0).select(*DIFF_COLUMNS)


def diff_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    qty = F.when(F.col("l_partkey") % 17 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    return (li.where(F.col("l_suppkey") % 10 != 1)
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", qty.alias("l_quantity"),
                    "l_returnflag", "l_shipdate"))


def sheet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One spreadsheet per nation, one row per customer, numbered within the sheet."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    rows = (c.join(n, c.c_nationkey == n.n_nationkey)
            .select(F.concat(F.lit("book"), F.col("n_regionkey").cast("string"), F.lit(".xlsx")).alias("file"),
                    F.col("n_name").alias("sheet"), "c_nationkey", "c_custkey", "c_name"))
    # row number inside a sheet; a sheet is a hot key by construction (25 sheets), and the
    # customer key is unique, so the block-wise numbering applies
    return occurrence_number_unique(rows, ["c_nationkey"], "c_custkey", out_col="rn")


HEADER_ROW = 2


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-form cell grid ``file, sheet, row_idx, col_idx, value`` with a title row, a
    header row (missing in one sheet), sparse dates in three layouts, amounts with
    thousands separators and subtotal rows."""
    rows = sheet_rows(spark, sf_dir)
    c = read_table(spark, sf_dir, "customer").select("c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    sheets = (c.join(n, c.c_nationkey == n.n_nationkey)
              .select(F.concat(F.lit("book"), F.col("n_regionkey").cast("string"), F.lit(".xlsx")).alias("file"),
                      F.col("n_name").alias("sheet"), "c_nationkey")
              .distinct())
    nk = F.col("c_nationkey")
    has_header = nk != 24

    def cell(row_idx, col_idx, value, keep=F.lit(True)):
        return F.when(keep, F.struct(F.lit(row_idx).cast("long").alias("row_idx") if isinstance(row_idx, int)
                                     else row_idx.cast("long").alias("row_idx"),
                                     F.lit(col_idx).cast("int").alias("col_idx"),
                                     value.cast("string").alias("value")))

    title_and_header = [
        cell(0, 0, F.lit("Voucher report")),
        cell(HEADER_ROW, 0, F.when(nk % 2 == 0, F.lit("憑單日期")).otherwise(F.lit("單據日期")), has_header),
        cell(HEADER_ROW, 1, F.lit("憑單單號"), has_header),
        cell(HEADER_ROW, 2, F.lit(" 廠商簡稱 "), has_header),
        cell(HEADER_ROW, 3, F.lit("金額"), has_header),
    ]
    ck = F.col("c_custkey")
    date_text = (F.when(ck % 3 == 0, F.concat(F.lit("2024/"), (ck % 12 + 1).cast("string"), F.lit("/"),
                                               (ck % 28 + 1).cast("string")))
                 .when(ck % 3 == 1, F.concat(F.lit("2024-"), (ck % 12 + 1).cast("string"), F.lit("-"),
                                             (ck % 28 + 1).cast("string")))
                 .otherwise((F.lit(45292) + ck).cast("string")))
    data_row = F.col("rn") + HEADER_ROW
    data = [
        cell(data_row, 0, date_text, F.col("rn") % 3 == 1),
        cell(data_row, 1, F.concat(F.lit("C"), ck.cast("string"))),
        cell(data_row, 2, F.when(F.col("rn") % 10 == 0, F.lit(" 小結:")).otherwise(F.col("c_name"))),
        cell(data_row, 3, F.concat((ck % 900 + 1).cast("string"), F.lit(",500.25"))),
    ]

    def explode(df, parts):
        # one pass over the input, several cells per input row; absent cells are nulls
        return (df.select("file", "sheet", F.explode(F.array(*parts)).alias("_c"))
                .where(F.col("_c").isNotNull()).select("file", "sheet", "_c.*"))

    return explode(sheets, title_and_header).unionByName(explode(rows, data))


def voucher_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cells`` with a payment term and a planned date in every sheet; every fourth sheet has
    a document date (some blank) beside its voucher date."""
    rows = sheet_rows(spark, sf_dir)
    nk, ck = F.col("c_nationkey"), F.col("c_custkey")
    month, day = (ck % 12 + 1).cast("string"), (ck % 28 + 1).cast("string")
    both = (nk % 4 == 0) & (nk != 24)

    def cell(row_idx, col_idx, value, keep=F.lit(True)):
        return F.when(keep, F.struct(row_idx.cast("long").alias("row_idx"), F.lit(col_idx).cast("int").alias("col_idx"),
                                     value.alias("value")))

    header, data, first = F.lit(HEADER_ROW), F.col("rn") + HEADER_ROW, F.col("rn") == 1
    parts = F.array(
        cell(header, 4, F.lit("單據日期"), first & both),
        cell(header, 5, F.lit("付款條件名稱"), first & (nk != 24)),
        cell(header, 6, F.lit("預計付款日"), first & (nk != 24)),
        cell(data, 4, F.concat(F.lit("2023/"), month, F.lit("/"), day), both & (ck % 7 != 0)),
        cell(data, 5, F.element_at(F.array(*[F.lit(t) for t in ("月結30天", "當月15號", "次月15號付款", "月結60天")]),
                                   (ck % 4 + 1).cast("int"))),
        cell(data, 6, F.concat(F.lit("2024/"), month, F.lit("/15"))))
    more = (rows.select("file", "sheet", F.explode(parts).alias("_c")).where(F.col("_c").isNotNull())
            .select("file", "sheet", "_c.*"))
    return cells(spark, sf_dir).unionByName(more)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw humidity/temperature replies, one per event; every 50th is malformed."""
    return replies_from_events(read_table(spark, sf_dir, "events"))


def replies_from_events(events: DataFrame) -> DataFrame:
    """The reply text for each event row (works on a batch or a streaming DataFrame)."""
    e = events.select("event_id", "ts", "user_id", "value")
    rh = (F.lit(30) + F.col("value") % 60).cast("decimal(6,3)").cast("string")
    temp = (F.lit(15) + F.col("user_id") % 20).cast("decimal(6,3)").cast("string")
    raw = (F.when(F.col("event_id") % 50 == 0, F.lit("{H00rdd 1;--.--;}"))
           .otherwise(F.concat(F.lit("{H00rdd 1;"), rh, F.lit("; %rh;0;-;"), temp,
                               F.lit(";  °C;0;HF5;000;]"))))
    return e.select("event_id", "ts", raw.alias("raw"))


def _hex2(c, width: int):
    return F.lpad(F.hex(c), width, "0")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register reply bodies (without CRC) as hex: complete replies with two registers,
    short replies (one register missing) and exception replies."""
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    ok_body = F.concat(F.lit("0304"),
                       _hex2(F.floor(F.col("value") * 10).cast("long") % 65536, 4),
                       F.when(F.col("event_id") % 25 == 0, F.lit(""))
                        .otherwise(_hex2(F.col("event_id") % 65536, 4)))
    body = F.concat(_hex2(F.col("user_id") % 247 + 1, 2),
                    F.when(F.col("event_id") % 40 == 0, F.lit("8302")).otherwise(ok_body))
    return e.select("event_id", "ts", body.alias("body_hex"))


# ---- fixed values: register windows of the probe (start address, length) -----------
PROBE_WINDOW_STARTS = [0, 20, 100, 200]


def captured_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured replies as binary frames -- the body plus its CRC (low byte first)."""
    from ..functions.registers import with_crc
    return frames(spark, sf_dir).select("event_id", "ts", with_crc(F.unhex("body_hex")).alias("frame"))


def probe_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start register of the request that produced each reply (one of the probe windows)."""
    e = read_table(spark, sf_dir, "events").select("event_id")
    starts = F.array(*[F.lit(s) for s in PROBE_WINDOW_STARTS])
    return e.select("event_id", F.try_element_at(starts, (F.col("event_id") % 4 + 1).cast("int")).alias("start"))


def request_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One read request per event: unit, function 3 (holding registers), window, 2 words."""
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id")
    starts = F.array(*[F.lit(s) for s in PROBE_WINDOW_STARTS])
    return e.select("event_id", (F.col("user_id") % 247 + 1).cast("int").alias("address"),
                    F.lit(3).alias("function"),
                    F.try_element_at(starts, (F.col("event_id") % 4 + 1).cast("int")).alias("start"),
                    F.lit(2).alias("count"))


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file listing (``folder, path, modificationTime``) over events: consolidation outputs
    named ``TOTAL_yyyyMMdd_HHmm.xlsx`` in one folder per event type, every 7th file named
    without a timestamp (its modification time an hour after the event)."""
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    name = (F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("report_"), F.col("event_id").cast("string"), F.lit(".xlsx")))
            .otherwise(F.concat(F.lit("TOTAL_"), F.date_format("ts", "yyyyMMdd_HHmm"), F.lit(".xlsx"))))
    mtime = F.when(F.col("event_id") % 7 == 0, F.col("ts") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("ts"))
    return e.select(F.col("event_type").alias("folder"),
                    F.concat(F.col("event_type"), F.lit("/"), name).alias("path"),
                    mtime.alias("modificationTime"))


def sync_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return o.select(F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("name"),
                    F.col("o_orderdate").alias("mtime"))


def sync_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the target already has: two thirds of the orders, half of them older."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate").where(F.col("o_orderkey") % 3 != 0)
    shift = F.when(F.col("o_orderkey") % 3 == 1, F.expr("INTERVAL -1 DAY")).otherwise(F.expr("INTERVAL 1 DAY"))
    return o.select(F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("name"),
                    (F.col("o_orderdate") + shift).alias("mtime"))


def text_dates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of the orders with dates as text: 2024/1/5 on the left, 2024-01-05 on the
    right (a day later in every 13th order); ``code`` is a number of the size of a day number,
    written with a decimal part on the right in every 11th order."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    k, code = F.col("o_orderkey"), (F.col("o_custkey") + 40000).cast("string")
    later = F.date_add(F.col("o_orderdate").cast("date"), F.when(k % 13 == 0, 1).otherwise(0))
    return (o.select("o_orderkey", F.date_format("o_orderdate", "yyyy/M/d").alias("written"), code.alias("code")),
            o.select("o_orderkey", F.date_format(later, "yyyy-MM-dd").alias("written"),
                     F.when(k % 11 == 0, F.concat(code, F.lit(".0"))).otherwise(code).alias("code")))


# ---- fixed values: layouts in which the order dates are written, cycled over the orders ----
WRITTEN_LAYOUTS = ["d MMMM yyyy", "MMM d, yyyy", "dd-MMM-yy", "EEEE, d MMMM yyyy", "M/d/yy", "dd.MM.yyyy",
                   "yyyy-MM-dd'T'HH:mm:ss", "yyyyMMddHHmmss", "MM/dd/yyyy hh:mm a", "yyyy MMM dd", "'30 Feb 'yyyy",
                   "'week 'd yyyy"]


def written_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as people write them; the last two layouts are no dates."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    n = len(WRITTEN_LAYOUTS)
    value = None
    for i, layout in enumerate(WRITTEN_LAYOUTS):
        cond, text = F.col("o_orderkey") % n == i, F.date_format("o_orderdate", layout)
        value = F.when(cond, text) if value is None else value.when(cond, text)
    return o.select("o_orderkey", value.alias("value"))
