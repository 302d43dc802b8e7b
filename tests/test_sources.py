"""File discovery, latest-file choice, CSV reads, sheet pick (S1-S4, S6-S8, S12) and the JDBC extract filter."""
import os
import tempfile
import time

from pyspark.sql import functions as F

from tallyho.operators import readings
from tallyho.sources import files, jdbc


def _touch(path, mtime):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(b"x")
    os.utime(path, (mtime, mtime))


def test_listing_and_latest(spark):
    root = tempfile.mkdtemp(prefix="tallyho-files-")
    now = time.time()
    _touch(os.path.join(root, "a", "x.xlsx"), now - 100)
    _touch(os.path.join(root, "a", "TOTAL_20250101_0900.xlsx"), now - 50)   # own output: skipped
    _touch(os.path.join(root, "a", "~$x.xlsx"), now)                        # lock file: skipped
    _touch(os.path.join(root, "a", "y.xls"), now - 10)
    _touch(os.path.join(root, "a", "notes.txt"), now)
    _touch(os.path.join(root, "a_backup", "z.xlsx"), now)
    _touch(os.path.join(root, "total", "t.xlsx"), now)
    listing = files.keep_folders(files.list_files(spark, root))
    assert sorted(r.file_name for r in listing.collect()) == ["x.xlsx", "y.xls"]
    latest = files.latest_files(listing).first()
    assert latest.latest_file.endswith("a/y.xls")


def test_latest_by_name_time(spark):
    rows = [("f", "f/TOTAL_20250102_0800.xlsx", 1), ("f", "f/TOTAL_20250101_0900.xlsx", 99)]
    listing = spark.createDataFrame(rows, "folder string, path string, modificationTime long") \
        .withColumn("modificationTime", F.col("modificationTime").cast("timestamp"))
    assert files.latest_files(listing).first().latest_file == "f/TOTAL_20250102_0800.xlsx"


def test_csv_reads(spark):
    root = tempfile.mkdtemp(prefix="tallyho-csv-")
    log = os.path.join(root, "log.csv")
    with open(log, "w", newline="") as fh:
        fh.write("timestamp,humidity_%RH,temperature_C\r\n2025/10/30 14:05,48.12,27.52\r\n"
                 "2025-10-30 14:06:10,48.2,27.4\r\n")
    parsed = readings.parse_log_lines(files.read_sensor_log(spark, log)).collect()
    assert [(str(r.ts), r.rh) for r in parsed] == [("2025-10-30 14:05:00", 48.12), ("2025-10-30 14:06:10", 48.2)]
    table = os.path.join(root, "t.csv")
    with open(table, "w") as fh:
        fh.write(" 單據日期 ,付款條件名稱\n2025.11.18,當月15號\n")
    df = files.read_all_strings(spark, table)
    assert df.columns == ["單據日期", "付款條件名稱"] and dict(df.dtypes)["單據日期"] == "string"
    assert files.previous_output_columns(spark, os.path.join(root, "missing")) is None


def test_pick_sheet(spark):
    cells = spark.createDataFrame([("b", 1, "x"), ("a", 0, "y")], "sheet string, sheet_idx int, value string")
    assert files.pick_sheet(cells).first().sheet == "a"
    assert files.pick_sheet(cells, "b").first().value == "x"
    try:
        files.pick_sheet(cells, "zz")
        raise AssertionError("expected a missing-sheet error")
    except ValueError:
        pass


def test_extract_filter_and_limit(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    out = jdbc.extract(o, "o_orderdate", "1996-01-01", "1997-01-01", limit=100, order=["o_orderkey"])
    rows = out.collect()
    assert len(rows) == 100 and all(r.o_orderdate.year == 1996 for r in rows)


def test_size_for_input(spark):
    from tallyho.session import size_for_input
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        parts = size_for_input(spark, 100 * 1024 ** 4)          # 100 TB of input
        assert parts == int(100 * 1024 ** 4 * 2 // (128 << 20)) + 1
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(parts)
        assert size_for_input(spark, 1000) == 200                 # small input: the floor
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
