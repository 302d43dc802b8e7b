"""Property checks on the spend, consolidation, streaming and sink paths."""
import os
import tempfile
import zipfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tallyho.operators import audit, cells, consolidate, spend
from tallyho.sources import fixtures, xlsx
from tallyho.streaming import readings as stream


def test_spend_properties(spark):
    v = fixtures.vouchers(spark, SF_SMALL)
    by_vendor = spend.spend_by(v, "vendor_name")
    total = sum(r.amount for r in by_vendor.collect())
    topk = spend.top_k_with_other(v, "vendor_name", k=5)
    rows = topk.collect()
    assert len(rows) == 6 and rows and abs(sum(r.amount for r in rows) - total) < 1e-3
    assert abs(sum(r.pct for r in rows) - 100.0) < 1e-6
    shares = spend.vendor_share(v).groupBy("term_name").agg(F.sum("pct").alias("p")).collect()
    assert len(shares) == 3 and all(abs(r.p - 100.0) < 1e-6 for r in shares)


def test_audit_counts_add_up(spark):
    a = audit.audit_payments(fixtures.vouchers(spark, SF_SMALL))
    c = audit.status_counts(a).first()
    assert c.total_rows == c.mismatches + c.skipped + c.unsupported + c.matched
    report = audit.audit_report(a)
    assert set(report) == {"counts", "by_term", "mismatches", "skipped", "unsupported", "all"}


def test_consolidation_lineage(spark):
    c = fixtures.cells(spark, SF_SMALL)
    res = consolidate.consolidate(c)
    assert res.table.count() == sum(r.rows for r in res.file_log.collect())
    assert res.errors.count() == 1
    # alias header detection finds the same header rows here
    assert cells.header_rows_by_alias(c).count() == cells.header_rows(c).count()


def _write_xlsx(path):
    sheet = ('<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
             '<row r="1"><c r="A1" t="s"><v>0</v></c></row>'
             '<row r="3"><c r="A3" t="s"><v>1</v></c><c r="B3" t="inlineStr"><is><t>憑單單號</t></is></c>'
             '<c r="C3" t="s"><v>2</v></c><c r="D3" t="inlineStr"><is><t>金額</t></is></c></row>'
             '<row r="4"><c r="A4"><v>45000</v></c><c r="B4" t="str"><v>V1</v></c><c r="C4" t="str"><v>ACME</v></c>'
             '<c r="D4"><v>1500.5</v></c></row>'
             '</sheetData></worksheet>')
    shared = ('<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
              '<si><t>Report</t></si><si><t>憑單日期</t></si><si><t>廠商簡稱</t></si></sst>')
    wb = ('<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
          'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
          '<sheets><sheet name="TOTAL" sheetId="1" r:id="rId1"/></sheets></workbook>')
    rels = ('<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
    with zipfile.ZipFile(path, "w") as zf:
        zf.writestr("xl/workbook.xml", wb)
        zf.writestr("xl/_rels/workbook.xml.rels", rels)
        zf.writestr("xl/sharedStrings.xml", shared)
        zf.writestr("xl/worksheets/sheet1.xml", sheet)


def test_xlsx_reader(spark):
    root = tempfile.mkdtemp(prefix="tallyho-xlsx-")
    os.makedirs(os.path.join(root, "dept"))
    _write_xlsx(os.path.join(root, "dept", "book.xlsx"))
    with open(os.path.join(root, "dept", "broken.xlsx"), "wb") as fh:
        fh.write(b"not a zip")
    files = spark.read.format("binaryFile").load(os.path.join(root, "dept", "*.xlsx"))
    raw = xlsx.read_workbooks(files)
    got = sorted((r.row_idx, r.col_idx, r.value) for r in xlsx.cells_of(raw).collect())
    assert got[:2] == [(0, 0, "Report"), (2, 0, "憑單日期")] and (3, 3, "1500.5") in got
    assert xlsx.errors_of(raw).count() == 1
    table = consolidate.consolidate(xlsx.cells_of(raw)).table.first()
    assert (str(table.voucher_date), table.voucher_no, table.vendor_name, table.amount, table.source_folder) == \
        ("2023-03-15", "V1", "ACME", 1500.5, "dept")


def test_stream_equals_batch(spark):
    import __spark_entry__ as entry
    q = entry.queries()
    s = q["readings_stream"](spark, SF_SMALL)
    b = q["readings_parsed"](spark, SF_SMALL)
    assert s.count() == b.count() and s.exceptAll(b).count() == 0


def test_pending_days(spark):
    days = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), ("2024-01-02",), ("2024-01-03",)], "day string")
    log = spark.createDataFrame([("2024-01-01",)], "day string")
    assert sorted(r.day for r in stream.pending_days(days, log).collect()) == ["2024-01-02", "2024-01-03"]


def test_sinks(spark):
    from tallyho.sinks import writers
    root = tempfile.mkdtemp(prefix="tallyho-sink-")
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    paths = writers.write_report({"t": df, "errors": df.limit(0)}, root, run_ts="20250101_000000",
                                 skip_empty=("errors",))
    assert set(paths) == {"t"} and spark.read.parquet(paths["t"]).count() == 2
    writers.write_tsv(df, os.path.join(root, "x.tsv"))
    text = sorted(r.value for r in spark.read.text(os.path.join(root, "x.tsv")).collect())
    assert text == ["1\tNone", "2\tb"]
    writers.append_run_log(spark, os.path.join(root, "log"), "done", rows=2)
    line = writers.format_log_lines(spark.read.parquet(os.path.join(root, "log"))).first().line
    assert line.endswith("] done")


def test_diff_report_written(spark):
    from tallyho.operators import diff
    from tallyho.sinks import writers
    left = spark.createDataFrame([("k", "1"), ("m", "3")], "key string, v string")
    right = spark.createDataFrame([("k", "2")], "key string, v string")
    tables = diff.diff_report(diff.diff_by_keys(left, right, ["key"]))
    root = tempfile.mkdtemp(prefix="tallyho-diff-")
    paths = writers.write_report(tables, root, run_ts="r1", skip_empty=("column_diff",))
    assert set(paths) == {"summary", "only_in_left", "only_in_right", "column_diff"}
    assert spark.read.parquet(paths["column_diff"]).count() == 1


def test_stream_continuous_trigger(spark):
    """The polling mode (processing-time trigger) drains the same rows."""
    from tallyho.sources.tables import read_table
    schema = read_table(spark, SF_SMALL, "events").schema
    src = stream.reply_stream(spark, SF_SMALL, schema, file_glob="events.parquet")
    parsed = stream.parsed_stream(fixtures.replies_from_events(src))
    out = stream.scratch_path(spark, "log-test")
    q = stream.run_reading_log(parsed, out, stream.scratch_path(spark, "ckpt-test"), trigger="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    good = spark.read.parquet(os.path.join(out, "good"))
    bad = spark.read.parquet(os.path.join(out, "rejected"))
    assert good.count() + bad.count() == read_table(spark, SF_SMALL, "events").count()
    assert bad.where("reject_reason = 'too few fields'").count() == bad.count() > 0


def test_drop_unnamed_variants(spark):
    from tallyho.operators.columns import align_to, drop_empty_unnamed, drop_unnamed, pick_column
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "a int, `Unnamed: 1` string, `Unnamed: 2` string")
    assert drop_empty_unnamed(df).columns == ["a", "Unnamed: 2"]
    assert drop_unnamed(df).columns == ["a"]
    assert align_to(df.select("a"), ["b", "a"]).columns == ["b", "a"]
    assert pick_column(["Amount (TWD)", "x"], ["amounttwd"], normalise=True) == "Amount (TWD)"


def test_catch_up(spark):
    root = tempfile.mkdtemp(prefix="tallyho-runs-")
    log = os.path.join(root, "runs")
    data = spark.createDataFrame([("d1", 1), ("d2", 2), ("d2", 3)], "day string, v int")
    first = stream.catch_up(data, log, lambda rows: rows.groupBy("day").count())
    assert sorted(r.day for r in first.collect()) == ["d1", "d2"]
    more = data.unionByName(spark.createDataFrame([("d3", 4)], "day string, v int"))
    second = stream.catch_up(more, log, lambda rows: rows.groupBy("day").count())
    assert [r.day for r in second.collect()] == ["d3"]


def test_subtotal_in_other_columns(spark):
    df = spark.createDataFrame([("A", 1.0, {"note": " 小結"}), ("B", 2.0, {"note": "ok"}), ("C", 3.0, None)],
                               "term_name string, amount double, other_columns map<string,string>")
    assert sorted(r.term_name for r in spend.drop_subtotal_rows(df).collect()) == ["B", "C"]
    assert spend.quality_counts(df).first().subtotal_rows == 1


def test_minute_rollup_stream(spark):
    """Streaming per-minute statistics (complete mode, memory sink) equal the batch ones."""
    from tallyho.operators import readings as ops
    from tallyho.sources.tables import read_table
    schema = read_table(spark, SF_SMALL, "events").schema
    src = stream.reply_stream(spark, SF_SMALL, schema, file_glob="events.parquet")
    roll = stream.rollup_stream(stream.parsed_stream(fixtures.replies_from_events(src)), "1 hour")
    q = roll.writeStream.outputMode("complete").format("memory").queryName("rollup_test") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.sql("SELECT * FROM rollup_test")
    batch = ops.stats(ops.good(ops.parse_replies(fixtures.readings(spark, SF_SMALL))), unit="hour") \
        .withColumnRenamed("hour", "bucket")
    cols = ["bucket", "n", "rh_min", "rh_max", "temp_c_min", "temp_c_max"]
    assert got.count() == batch.count() > 0
    assert got.select(*cols).exceptAll(batch.select(*cols)).count() == 0
    diff = got.join(batch, "bucket").where(F.abs(got.rh_avg - batch.rh_avg) > 1e-9).count()
    assert diff == 0


def test_rollup_append_emits_finished_buckets(spark):
    from tallyho.operators import readings as ops
    from tallyho.sources.tables import read_table
    schema = read_table(spark, SF_SMALL, "events").schema
    src = stream.reply_stream(spark, SF_SMALL, schema, file_glob="events.parquet")
    roll = stream.rollup_stream(stream.parsed_stream(fixtures.replies_from_events(src)), "1 hour", "1 hour")
    out = stream.scratch_path(spark, "rollup-out")
    q = stream.run_rollup(roll, out, stream.scratch_path(spark, "rollup-ckpt"))
    q.awaitTermination()
    got = spark.read.parquet(out)
    good = ops.good(ops.parse_replies(fixtures.readings(spark, SF_SMALL)))
    max_ts = good.agg(F.max("ts")).first()[0]
    batch = ops.stats(good, unit="hour").withColumnRenamed("hour", "bucket")
    import datetime as dt
    finished = batch.where(F.col("bucket") + F.expr("INTERVAL 1 HOUR") <= F.lit(max_ts - dt.timedelta(hours=1)))
    cols = ["bucket", "n", "rh_min", "rh_max"]
    assert got.count() == finished.count() > 0
    assert got.select(*cols).exceptAll(finished.select(*cols)).count() == 0


def test_stream_csv_log(spark):
    from tallyho.sources.tables import read_table
    schema = read_table(spark, SF_SMALL, "events").schema
    src = stream.reply_stream(spark, SF_SMALL, schema, file_glob="events.parquet")
    parsed = stream.parsed_stream(fixtures.replies_from_events(src))
    out = stream.scratch_path(spark, "csv-log")
    stream.run_reading_log(parsed, out, stream.scratch_path(spark, "csv-ckpt"), fmt="csv").awaitTermination()
    log = spark.read.option("header", True).csv(os.path.join(out, "good"))
    assert {"event_id", "ts", "rh", "temp_c"} <= set(log.columns) and log.count() == 980


def test_report_rerun_is_idempotent(spark):
    from tallyho.sinks import writers
    root = tempfile.mkdtemp(prefix="tallyho-rerun-")
    df = spark.createDataFrame([(1,), (2,)], "a int")
    writers.write_report({"t": df}, root, run_ts="r1")
    writers.write_report({"t": df}, root, run_ts="r1")     # retried run
    writers.write_report({"t": df.limit(1)}, root, run_ts="r2")
    t = spark.read.parquet(os.path.join(root, "t"))
    assert t.where("run_ts = 'r1'").count() == 2 and t.where("run_ts = 'r2'").count() == 1


def test_stream_restart_from_checkpoint(spark):
    """A restarted log stream resumes from its checkpoint: nothing is read or written twice."""
    from tallyho.sources.tables import read_table
    schema = read_table(spark, SF_SMALL, "events").schema
    out = stream.scratch_path(spark, "restart-log")
    ckpt = stream.scratch_path(spark, "restart-ckpt")
    for _ in range(2):
        src = stream.reply_stream(spark, SF_SMALL, schema, file_glob="events.parquet")
        parsed = stream.parsed_stream(fixtures.replies_from_events(src))
        stream.run_reading_log(parsed, out, ckpt).awaitTermination()
    good = spark.read.parquet(os.path.join(out, "good"))
    assert good.count() == good.select("event_id").distinct().count() == 980
