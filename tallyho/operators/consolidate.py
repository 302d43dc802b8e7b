"""Voucher consolidation (entry 1): many sheets -> one aligned voucher table.

header row (H1) -> column map (H7) -> rows (H3/H4) -> date fill-down (W1) and parse
(D1) -> keep dated rows (P1) -> clean text (F1) and amounts (F4) -> provenance (H10) ->
union (U1, free: every sheet is already in one DataFrame) -> order (O1).
Side outputs: rows kept per sheet (A8) and sheets without a header (H13).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.dates import sheet_date
from ..functions.text import clean_cell, parse_number, strip
from ..session import landed
from . import cells as C
from .skew import GROUP_ROWS, fill_down, global_index

TEXT_COLUMNS = ["voucher_no", "vendor_code", "vendor_name", "term_code", "term_name"]
DATE_COLUMNS = ["planned_pay_date", "cash_date"]
OUTPUT_COLUMNS = ["voucher_date", "doc_date", "voucher_no", "vendor_code", "vendor_name", "term_code", "term_name",
                  "planned_pay_date", "cash_date", "amount", "source_folder", "source_file", "sheet_name",
                  "source_row", "other_columns"]


@dataclass
class Consolidated:
    table: DataFrame
    file_log: DataFrame
    errors: DataFrame


def consolidate(cells: DataFrame, header_keys=config.HEADER_KEYS, min_hits: int = config.HEADER_MIN_HITS,
                fill_block_rows: int = 1 << 20) -> Consolidated:
    headers = C.header_rows(cells, header_keys, min_hits)
    colmap = C.column_map(cells, headers)
    # a sheet with a document date beside its voucher date: that column is the document date,
    # blank or not; elsewhere the voucher date is
    cols = F.col("cols")
    own = cols.getItem("doc_date") != cols.getItem("voucher_date")
    rows = C.sheet_rows_wide(cells, colmap.select("*", F.coalesce(own, F.lit(False)).alias("_tly_own_doc")),
                             per_sheet=("_tly_own_doc",))
    # The date text is filled down within a sheet before parsing ('', 'nan', 'NaT'
    # count as missing); skew-safe forward fill in blocks of rows
    raw_date = strip(F.col("voucher_date"))
    rows = rows.withColumn("_tly_date_text",
                           F.when(~raw_date.isin("", "nan", "NaT"), raw_date))
    rows = fill_down(rows, C.SHEET, "row_idx", "_tly_date_text", block_rows=fill_block_rows)
    dated = rows.withColumn("voucher_date", sheet_date(F.col("_tly_date_text"))).where(F.col("voucher_date").isNotNull())
    folder = F.col("folder") if "folder" in cells.columns else F.lit(None).cast("string")
    table = dated.select(
        "voucher_date",
        F.when(F.col("_tly_own_doc"), sheet_date(F.col("doc_date"))).otherwise(F.col("voucher_date")).alias("doc_date"),
        *[clean_cell(F.col(c)).alias(c) for c in TEXT_COLUMNS],
        *[sheet_date(F.col(c)).alias(c) for c in DATE_COLUMNS],
        parse_number(F.col("amount")).alias("amount"),
        folder.alias("source_folder"), F.col("file").alias("source_file"),
        F.col("sheet").alias("sheet_name"), F.col("row_idx").alias("source_row"),
        F.transform_values("other_columns", lambda k, v: clean_cell(v)).alias("other_columns"))
    file_log = table.groupBy("source_folder", "source_file", "sheet_name").agg(F.count(F.lit(1)).alias("rows"))
    return Consolidated(table, file_log, C.missing_header_errors(cells, headers))


def ordered(table: DataFrame, ascending: bool = True) -> DataFrame:
    """O1: by date, folder, file, sheet, then grid row (pandas' stable sort keeps file order)."""
    cols = ["voucher_date", "source_folder", "source_file", "sheet_name", "source_row"]
    return table.orderBy(*[F.col(c).asc_nulls_last() if ascending else F.col(c).desc_nulls_last() for c in cols])


def indexed(table: DataFrame, ascending: bool = True, group_rows: int = GROUP_ROWS) -> DataFrame:
    """O1 with the index reset: ``ordered``'s rows with their position ``pos`` from 0, as a column.

    The table is written once, as its position is measured in several passes.  Nulls come last
    either way: descending is the ascending order (nulls first) counted from its end.
    """
    table = landed(table, "consolidated")
    cols = [F.col(c) for c in ("voucher_date", "source_folder", "source_file", "sheet_name", "source_row")]
    order = [e for c in cols for e in (c.isNull(), c)] if ascending else cols
    out = global_index(table, order, "pos", group_rows)
    return out.withColumn("pos", F.col("pos") - 1 if ascending else F.lit(table.count()) - F.col("pos"))
