"""Golden rows for the payment-term rules (D7 + P8), date parsing (D1, D3) and amounts."""
import datetime as dt

from pyspark.sql import functions as F

from tallyho.functions import dates, text

D = dt.date

# doc_date, term, vendor, expected, rule
EXPECTED = [
    (D(2025, 11, 20), "當月15號", "A", D(2025, 11, 15), 2),
    (D(2025, 11, 18), "當月18號付款", "A", D(2025, 11, 18), 3),
    (D(2025, 12, 19), "當月18號付款", "A", D(2026, 1, 18), 3),
    (D(2025, 12, 31), "次月15號付款", "A", D(2026, 1, 15), 4),
    (D(2025, 12, 31), "次月15號付款", "南科管理局", D(2025, 12, 15), 9),
    (D(2025, 10, 5), "月結18天", "A", D(2025, 11, 18), 5),
    (D(2025, 10, 5), "月結48天", "A", D(2025, 12, 18), 5),
    (D(2025, 10, 5), "月結 78 天", "A", D(2026, 1, 18), 5),
    (D(2025, 1, 31), "月結30天", "A", D(2025, 2, 28), 6),
    (D(2024, 12, 31), "月結60天", "A", D(2025, 2, 28), 6),
    (D(2025, 10, 5), "月結120天", "A", D(2026, 2, 28), 6),
    (D(2025, 10, 5), "月結90天", "A", None, 7),
    (D(2025, 10, 5), "請財務部確認付款日", "A", None, 1),
    (D(2025, 10, 5), None, "A", None, 0),
    (None, "月結30天", "A", None, 0),
    (D(2025, 10, 5), "月結３０天", "A", D(2025, 11, 30), 6),     # full-width digits (T8)
    (D(2025, 10, 5), "　當月15號 ", "A", D(2025, 10, 15), 2),  # Unicode whitespace (T7)
    (D(2025, 10, 5), "   ", "A", None, 0),
    (D(2025, 10, 5), "貨到付款", "A", None, 8),
]


def test_expected_pay_date(spark):
    df = spark.createDataFrame(EXPECTED, "d date, term string, vendor string, want date, rule int")
    out = dates.with_expected_pay_date(df, "d", "term", "vendor").collect()
    for r in out:
        assert (r.expected_pay_date, r.pay_rule) == (r.want, r.rule), r


SHEET_DATES = [("2025/1/5", D(2025, 1, 5)), ("2025-1-5", D(2025, 1, 5)), ("45000", D(2023, 3, 15)),
               ("45000.6", D(2023, 3, 15)), ("20251118", None), ("2025/02/30", None),
               ("2025-11-18 00:00:00", D(2025, 11, 18)), (" 2025/12/01 ", D(2025, 12, 1)), ("abc", None), (None, None)]


def test_sheet_date(spark):
    df = spark.createDataFrame(SHEET_DATES, "s string, want date")
    for r in df.select("want", dates.sheet_date(F.col("s")).alias("got")).collect():
        assert r.got == r.want


def test_lenient_date(spark):
    rows = [("2025.11.18", D(2025, 11, 18)), ("2025/1/5", D(2025, 1, 5)), ("20251118", D(2025, 11, 18)),
            ("11/18/2025", D(2025, 11, 18)), ("18/11/2025", D(2025, 11, 18)), ("x", None)]
    df = spark.createDataFrame(rows, "s string, want date")
    for r in df.select("want", dates.lenient_date(F.col("s")).alias("got")).collect():
        assert r.got == r.want


AMOUNTS = [("1,000", 1000.0), (" 7 ", 7.0), ("+5", 5.0), ("1e3", 1000.0), ("1d", None), ("0x10", None),
           ("(5)", None), ("nan", None), ("", None), (None, None), (".5", 0.5), ("1,500.25", 1500.25)]


def test_parse_number(spark):
    df = spark.createDataFrame(AMOUNTS, "s string, want double")
    for r in df.select("want", text.parse_number(F.col("s")).alias("got")).collect():
        assert r.got == r.want


def test_clean_text(spark):
    df = spark.createDataFrame([("a\x00b\x86c\t\n\r\x85d",)], "s string")
    r = df.select(text.clean_cell(F.col("s")).alias("a"), text.clean_report_text(F.col("s")).alias("b")).first()
    assert r.a == "abc\t\n\r\x85d"
    assert r.b == "ab\x86c\t\n\r\x85d"


def test_strip_and_blank(spark):
    df = spark.createDataFrame([("　 x \t",), ("NaT",), ("  ",), (None,), ("v",)], "s string")
    got = df.select(text.strip(F.col("s")).alias("s"), text.is_blank(F.col("s")).alias("b")).collect()
    assert [(r.s, r.b) for r in got] == [("x", False), ("NaT", True), ("", True), (None, True), ("v", False)]


def test_norm_name(spark):
    df = spark.createDataFrame([(" Amount (TWD) ",), ("付款條件【名稱】",)], "s string")
    assert [r[0] for r in df.select(text.norm_name(F.col("s"))).collect()] == ["amounttwd", "付款條件名稱"]
