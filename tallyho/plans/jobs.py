"""End-to-end jobs: the original tool's entry points as Spark jobs.

Each job wires sources -> operators -> sinks; all the work is in the operators.  Output
tables go under ``out_root/<table>/run_ts=<run>/`` (K1-K5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators import audit, cells as C, consolidate, diff, extract, spend
from ..operators.columns import align_to, drop_unnamed
from ..session import landed
from ..sinks import writers
from ..sources import files, jdbc, xlsx


def workbook_cells(spark: SparkSession, base_dir: str, recursive: bool = False,
                   wide: bool = False) -> tuple[DataFrame, DataFrame]:
    """S1 + S2 + S5: cells and read errors of every workbook in the sub-folders, parsed once and written."""
    exts = config.WORKBOOK_EXTENSIONS_WIDE if wide else config.WORKBOOK_EXTENSIONS
    loaded = files.keep_folders(files.list_files(spark, base_dir, exts, recursive=recursive, with_content=True),
                                drop_hidden=wide)
    raw = landed(xlsx.read_workbooks(loaded), "workbooks")
    return xlsx.cells_of(raw), xlsx.errors_of(raw)


def consolidation_job(spark: SparkSession, base_dir: str, out_root: str, template_path: str | None = None,
                      run_ts: str | None = None) -> dict[str, str]:
    """Entry 1: all workbooks of the sub-folders -> TOTAL, SUMMARY and ERRORS tables."""
    cells, read_errors = workbook_cells(spark, base_dir)
    res = consolidate.consolidate(cells)
    template = files.previous_output_columns(spark, template_path) if template_path else None
    total = consolidate.ordered(res.table)
    if template:
        total = align_to(total, [c for c in template if c != "run_ts"])
    errors = res.errors.select(F.concat_ws("::", "file", "sheet").alias("file"), "error").unionByName(read_errors)
    return writers.write_report({"TOTAL": total, "SUMMARY": res.file_log, "ERRORS": errors}, out_root,
                                run_ts, skip_empty=("ERRORS",))


def audit_job(spark: SparkSession, total_root: str, out_root: str, run_ts: str | None = None) -> dict[str, str]:
    """Entry 2: the latest consolidated run -> the six audit tables."""
    total = spark.read.parquet(total_root)
    if "run_ts" in total.columns:
        # The newest run (partition pruning on run_ts)
        latest = total.agg(F.max("run_ts")).scalar()
        total = total.where(F.col("run_ts") == latest).drop("run_ts")
    if "doc_date" not in total.columns and "voucher_date" in total.columns:
        total = total.withColumn("doc_date", F.col("voucher_date"))
    return writers.write_report(audit.audit_report(audit.audit_payments(total)), out_root, run_ts)


def diff_job(left: DataFrame, right: DataFrame, out_root: str, keys: list[str] | None = None,
             case_insensitive: bool = False, run_ts: str | None = None,
             left_name: str = "left", right_name: str = "right", date_cols: list[str] | None = None,
             order: list[str] | None = None, surplus: str = "unpaired") -> dict[str, str]:
    """Diff entry: given keys (must exist on both sides, H12), else automatic keys (J1),
    else the keyless row diff (J4).  Date columns are the given ones, else those that the
    values show to be dates (D2); ``order`` and ``surplus`` go to the keyed diff."""
    left, right = drop_unnamed(left), drop_unnamed(right)
    if keys:
        for side, df in (("left", left), ("right", right)):
            missing = [k for k in keys if k not in df.columns]
            if missing:
                raise ValueError(f"key columns {missing} not in the {side} table")
        lk = keys
    else:
        lk, rk = diff.pick_keys(left.columns, right.columns)
        right = right.toDF(*[lk[rk.index(c)] if c in rk else c for c in right.columns])
    if date_cols is None:
        date_cols = diff.date_columns(left, right)
    if lk:
        result = diff.diff_by_keys(left, right, lk, order, date_cols=date_cols, case_insensitive=case_insensitive,
                                   surplus=surplus)
        tables = diff.diff_report(result, left_name, right_name)
    else:
        only_l, only_r = diff.diff_rows(left, right, case_insensitive, date_cols=date_cols)
        empty = only_l.sparkSession.createDataFrame([], "key string, column string, left_value string, "
                                                        "right_value string")
        result = diff.DiffResult([], only_l, only_r, empty, empty)
        tables = {"summary": diff.diff_summary(result, left_name, right_name), "only_in_left": only_l,
                  "only_in_right": only_r, "column_diff": empty}
    return writers.write_report(tables, out_root, run_ts, skip_empty=("column_diff",))


SPEND_COLUMNS = {"term_name": config.SPEND_TERM_ALIASES, "amount": config.SPEND_AMOUNT_ALIASES,
                 "vendor_name": config.SPEND_VENDOR_ALIASES}


def spend_table(cells: DataFrame) -> DataFrame:
    """Entry 3 input: header row by alias (H2), columns matched after normalisation
    (H6/H7); sheets without both a term and an amount column are skipped."""
    headers = C.header_rows_by_alias(cells)
    colmap = C.column_map(cells, headers, SPEND_COLUMNS, date_col=None, normalise=True)
    colmap = colmap.where(F.col("cols").getItem("term_name").isNotNull()
                          & F.col("cols").getItem("amount").isNotNull())
    return C.sheet_rows_wide(cells, colmap, SPEND_COLUMNS)


def spend_job(spark: SparkSession, base_dir: str, out_root: str, run_ts: str | None = None) -> dict[str, str]:
    """Entry 3: the newest workbook of every folder -> summary, top-3, vendor shares, a summary a folder and read errors.

    The newest file per folder is chosen from the listing (S3: file metadata); the files are
    semi-joined with it, so only those workbooks are read and no path passes the driver."""
    loaded = files.keep_folders(files.list_files(spark, base_dir, config.WORKBOOK_EXTENSIONS_WIDE, with_content=True),
                                drop_hidden=True)
    newest = extract.latest_per_folder(loaded.drop("content"), use_name_time=False).select(F.col("latest_file").alias("path"))
    if newest.isEmpty():
        raise ValueError(f"no workbook under {base_dir}")
    raw = landed(xlsx.read_workbooks(loaded.join(newest, "path", "left_semi")), "workbooks")
    table = spend_table(xlsx.cells_of(raw))
    if spend.spend_rows(table).isEmpty():
        raise ValueError(f"no row with a payment term and an amount in the newest workbooks under {base_dir}")
    tables = {"summary": spend.top_k_with_other(table), "top3": spend.top_terms(table),
              "vendor_share": spend.vendor_share(table), "folder_summary": spend.top_k_by_group(table, "folder"),
              "ERRORS": xlsx.errors_of(raw)}
    return writers.write_report(tables, out_root, run_ts, skip_empty=("ERRORS",), partition_by={"vendor_share": ["term_name"], "folder_summary": ["folder"]})


def extract_job(spark: SparkSession, url: str, view: str, out_path: str, log_path: str, **jdbc_options) -> int:
    """Database extract: TOP 100 of a view -> headerless TSV (K6), run log lines (K8)."""
    writers.append_run_log(spark, log_path, f"extract {view}: start")
    try:
        # K8: the rows are counted by the pass that writes them
        seen = Observation()
        rows = jdbc.extract(jdbc.read_view(spark, url, view, **jdbc_options)).observe(seen, F.count(F.lit(1)).alias("rows"))
        writers.write_tsv(rows, out_path)
        n = seen.get["rows"]
        writers.append_run_log(spark, log_path, f"extract {view}: done", rows=n)
        return n
    except Exception as exc:
        writers.append_run_log(spark, log_path, f"extract {view}: {type(exc).__name__}: {exc}", level="ERROR")
        raise
