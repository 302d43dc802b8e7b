"""End-to-end jobs on generated workbooks: consolidation -> audit, spend, diff."""
import os
import tempfile
import zipfile
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import functions as F

from tallyho.operators import spend
from tallyho.plans import jobs

HEADER = ["憑單日期", "憑單單號", "廠商簡稱", "付款條件名稱", "預計付款日", "本幣貨款金額", "備註"]


def _col_letter(i):
    return chr(65 + i)


def write_xlsx(path, sheets):
    """Minimal workbook: ``sheets`` = {name: [[cell, ...], ...]}; numbers stay numbers."""
    wb_sheets, rels, parts = [], [], {}
    for n, (name, rows) in enumerate(sheets.items(), start=1):
        xml_rows = []
        for r, row in enumerate(rows, start=1):
            cells = []
            for c, v in enumerate(row):
                if v is None:
                    continue
                ref = f"{_col_letter(c)}{r}"
                if isinstance(v, (int, float)):
                    cells.append(f'<c r="{ref}"><v>{v}</v></c>')
                else:
                    cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{escape(v)}</t></is></c>')
            xml_rows.append(f'<row r="{r}">{"".join(cells)}</row>')
        parts[f"xl/worksheets/sheet{n}.xml"] = (
            '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
            + "".join(xml_rows) + "</sheetData></worksheet>")
        wb_sheets.append(f'<sheet name="{escape(name)}" sheetId="{n}" r:id="rId{n}"/>')
        rels.append(f'<Relationship Id="rId{n}" Type="worksheet" Target="worksheets/sheet{n}.xml"/>')
    parts["xl/workbook.xml"] = (
        '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
        'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>'
        + "".join(wb_sheets) + "</sheets></workbook>")
    parts["xl/_rels/workbook.xml.rels"] = (
        '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        + "".join(rels) + "</Relationships>")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w") as zf:
        for name, xml in parts.items():
            zf.writestr(name, xml)


def _books(root):
    write_xlsx(os.path.join(root, "north", "book.xlsx"), {
        "Jan": [["Voucher list"], [], HEADER,
                ["2025/11/20", "V1", "ACME", "當月15號", "2025/11/15", "1,000", "rush"],
                [None, "V2", "ACME", "次月15號付款", "2025/12/10", 250.5],
                ["2025-12-31", "V3", "南科管理局", "次月15號付款", "2025/12/15", 99],
                [None, None, " 小結:", None, None, "1,349.5"]],
        "Notes": [["nothing here"]]})
    write_xlsx(os.path.join(root, "south", "book.xlsx"), {
        "Feb": [HEADER, [45000, "V4", "Beta", "月結30天", "2023/04/30", 10]]})
    write_xlsx(os.path.join(root, "total", "TOTAL_20250101_0000.xlsx"), {"TOTAL": [HEADER]})   # own output


def test_consolidation_then_audit(spark):
    root = tempfile.mkdtemp(prefix="tallyho-jobs-")
    _books(root)
    out = os.path.join(root, "_out")
    paths = jobs.consolidation_job(spark, root, out, run_ts="r1")
    total = spark.read.parquet(paths["TOTAL"])
    got = {r.voucher_no: (str(r.voucher_date), r.amount) for r in total.collect() if r.voucher_no}
    assert got == {"V1": ("2025-11-20", 1000.0), "V2": ("2025-11-20", 250.5), "V3": ("2025-12-31", 99.0),
                   "V4": ("2023-03-15", 10.0)}
    extra = {r.voucher_no: r.other_columns for r in total.collect() if r.voucher_no}
    assert extra["V1"] == {"備註": "rush"} and extra["V2"] == {}
    errors = spark.read.parquet(paths["ERRORS"]).collect()
    assert [e.file.split("::")[-1] for e in errors] == ["Notes"]
    summary = {(r.source_folder, r.sheet_name): r.rows for r in spark.read.parquet(paths["SUMMARY"]).collect()}
    assert summary == {("north", "Jan"): 4, ("south", "Feb"): 1}

    reports = jobs.audit_job(spark, paths["TOTAL"], os.path.join(out, "audit"), run_ts="r1")
    counts = spark.read.parquet(reports["counts"]).first()
    assert counts.total_rows == 5 and counts.matched == 3 and counts.mismatches == 1
    mism = spark.read.parquet(reports["mismatches"]).first()
    assert (mism.voucher_no, str(mism.expected_pay_date), mism.days_diff) == ("V2", "2025-12-15", -5)


def test_document_date_goes_before_voucher_date(spark):
    root = tempfile.mkdtemp(prefix="tallyho-docdate-")
    head = ["憑單日期", "單據日期", "憑單單號", "廠商簡稱", "付款條件名稱", "預計付款日", "本幣貨款金額"]
    write_xlsx(os.path.join(root, "north", "book.xlsx"), {
        "both": [head, ["2025/11/20", "2025/10/05", "V1", "ACME", "月結30天", "2025/11/30", 10],
                 [None, None, "V2", "ACME", "月結30天", "2025/11/30", 10]],
        "one": [["單據日期", *head[2:]], ["2025/10/05", "V3", "ACME", "月結30天", "2025/11/30", 10],
                [None, "V4", "ACME", "月結30天", "2025/12/30", 10]]})
    out = os.path.join(root, "_out")
    paths = jobs.consolidation_job(spark, root, out, run_ts="r1")
    reports = jobs.audit_job(spark, paths["TOTAL"], os.path.join(out, "audit"), run_ts="r1")
    got = {r.voucher_no: (str(r.doc_date), r.audit_status) for r in spark.read.parquet(reports["all"]).collect()}
    assert got["V1"] == ("2025-10-05", "match") and got["V2"][0] == "None"
    assert got["V3"] == ("2025-10-05", "match") and got["V4"] == ("2025-10-05", "mismatch")


def test_audit_without_a_planned_date_column(spark):
    df = spark.createDataFrame([("2025/10/05", "月結30天"), (None, "月結30天")], "`單據日期` string, `付款條件名稱` string")
    rows = jobs.audit.audit_payments(df).collect()
    assert all(r.is_consistent is None and r.audit_status != "mismatch" for r in rows)
    assert "not compared" in {r.audit_status for r in rows}


def test_spend_job(spark):
    root = tempfile.mkdtemp(prefix="tallyho-spend-")
    _books(root)
    paths = jobs.spend_job(spark, root, os.path.join(root, "_out"), run_ts="r1")
    summary = {r.term_name: r.amount for r in spark.read.parquet(paths["summary"]).collect()}
    assert summary == {"當月15號": 1000.0, "次月15號付款": 349.5, "月結30天": 10.0}
    top3 = spark.read.parquet(paths["top3"]).orderBy("rank").collect()
    assert [r.term_name for r in top3] == ["當月15號", "次月15號付款", "月結30天"]
    folders = spark.read.parquet(paths["folder_summary"])
    assert "folder" in folders.columns and folders.agg(F.sum("amount")).first()[0] == sum(summary.values())
    empty = tempfile.mkdtemp(prefix="tallyho-empty-")
    os.makedirs(os.path.join(empty, "z"))
    open(os.path.join(empty, "z", "notes.txt"), "w").close()
    with pytest.raises(ValueError, match="no workbook"):
        jobs.spend_job(spark, empty, os.path.join(empty, "_out"))
    bare = tempfile.mkdtemp(prefix="tallyho-spend-")
    write_xlsx(os.path.join(bare, "z", "bare.xlsx"), {"s": [HEADER]})
    with pytest.raises(ValueError, match="no row"):
        jobs.spend_job(spark, bare, os.path.join(bare, "_out"))


def test_top_k_of_every_group(spark):
    """Each group's ranking equals the one-group report over that group alone; ties go by name, null is a group."""
    rows = [(g, f"v{(i * 7 + n) % 23:02d}" if i % 9 else None, float((i * 13) % 40 - 4)) for n, g in enumerate(["a", "b", None]) for i in range(60 - 20 * n)]
    rows += [("one", "v", 5.0), ("none", None, 1.0), ("zero", "p", 1.0), ("zero", "q", -1.0)]
    df = spark.createDataFrame(rows, "folder string, vendor string, amount double")
    got = {}
    for r in spend.top_k_by_group(df, "folder", "vendor", k=4).collect():
        got.setdefault(r.folder, []).append((r["rank"], r.vendor, r.amount, r.pct))
    assert got.keys() == {"a", "b", None, "one", "zero"}
    for g, ranked in got.items():
        alone = spend.top_k_with_other(df.where(F.col("folder").eqNullSafe(F.lit(g))).drop("folder"), "vendor", k=4)
        assert sorted(ranked) == sorted(map(tuple, alone.collect()))
    assert spend.top_k_by_group(df.limit(0), "folder", "vendor").count() == 0


def test_spend_job_reports_what_it_cannot_read(spark):
    root = tempfile.mkdtemp(prefix="tallyho-spend-")
    _books(root)
    write_xlsx(os.path.join(root, "z1", "whole.xlsx"), {"s1": [HEADER], "s2": [HEADER]})
    os.makedirs(os.path.join(root, "z2"))
    with zipfile.ZipFile(os.path.join(root, "z1", "whole.xlsx")) as whole, \
            zipfile.ZipFile(os.path.join(root, "z2", "part.xlsx"), "w") as part:
        for name in whole.namelist():
            if not name.endswith("sheet2.xml"):
                part.writestr(name, whole.read(name))
    os.makedirs(os.path.join(root, "z3"))
    with open(os.path.join(root, "z3", "bad.xlsx"), "wb") as f:
        f.write(b"no zip")
    paths = jobs.spend_job(spark, root, os.path.join(root, "_out"), run_ts="r1")
    errors = {os.path.basename(r.file): r.error for r in spark.read.parquet(paths["ERRORS"]).collect()}
    assert {"part.xlsx", "bad.xlsx"} <= errors.keys() and "whole.xlsx" not in errors and "s2" in errors["part.xlsx"]


def test_diff_job(spark):
    left = spark.createDataFrame([("V1", "1", "a"), ("V2", "1", "b"), ("V2", "1", "b")], "`憑單單號` string, `項次` string, x string")
    right = spark.createDataFrame([("V1", "1", "A"), ("V2", "1", "b")], "`憑單單號` string, `項次` string, x string")
    root = tempfile.mkdtemp(prefix="tallyho-diffjob-")
    paths = jobs.diff_job(left, right, root, run_ts="r1")
    s = spark.read.parquet(paths["summary"]).first()
    assert (s.keys_used, s.only_in_left_rows, s.only_in_right_rows, s.column_diff_rows) == ("憑單單號, 項次", 1, 0, 1)
    nokey = jobs.diff_job(left.select("x"), right.select("x"), os.path.join(root, "nk"), run_ts="r1")
    s2 = spark.read.parquet(nokey["summary"]).first()
    assert (s2.keys_used, s2.only_in_left_rows, s2.only_in_right_rows) == ("(none)", 1, 1)
