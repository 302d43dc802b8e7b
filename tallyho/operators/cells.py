"""Cell grids: header detection and grid -> table.

A workbook is held as a long ``cells`` DataFrame ``file, sheet, row_idx, col_idx, value``
(one row per non-empty cell; an optional ``folder`` column carries provenance).  Nothing
here collects a sheet: header rows come from aggregates, header names are attached with
a join on ``(file, sheet, col_idx)``, and rows are assembled by a row-level aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.text import norm_name, norm_name_py, strip

SHEET = ["file", "sheet"]
ROW_BLOCK_BITS = 16   # joins of rows with their sheet's header go by blocks of 2^16 rows


def non_blank(cells: DataFrame) -> DataFrame:
    """H4: a cell counts only when its text is not empty (whitespace-only text counts)."""
    return cells.where(F.col("value").isNotNull() & (F.col("value") != ""))


def header_rows(cells: DataFrame, keys=config.HEADER_KEYS, min_hits: int = config.HEADER_MIN_HITS) -> DataFrame:
    """H1: per sheet, the first row holding at least ``min_hits`` distinct known header
    names (cells compared after strip, exact match)."""
    v = strip(F.col("value"))
    return (non_blank(cells).where(v.isin(*keys))
            # distinct known names per grid row (a set bounded by the row's width: one
            # aggregation, combined map-side, instead of a distinct-aggregate plan)
            .groupBy(*SHEET, "row_idx").agg(F.size(F.collect_set(v)).alias("hits"))
            .where(F.col("hits") >= min_hits)
            .groupBy(*SHEET).agg(F.min("row_idx").alias("header_row")))


def header_rows_by_alias(cells: DataFrame, aliases=None) -> DataFrame:
    """H2 + H6: per sheet, the first row holding any (normalised) term or amount alias."""
    aliases = aliases or (config.SPEND_TERM_ALIASES + config.SPEND_AMOUNT_ALIASES)
    keys = sorted({norm_name_py(a) for a in aliases})
    return (non_blank(cells).where(norm_name(F.col("value")).isin(*keys))
            .groupBy(*SHEET).agg(F.min("row_idx").alias("header_row")))


def sheets(cells: DataFrame) -> DataFrame:
    cols = [*SHEET, "folder"] if "folder" in cells.columns else SHEET
    return cells.select(*cols).distinct()


def missing_header_errors(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """One error row per sheet without a header row; the job continues."""
    return (sheets(cells).select(*SHEET).join(headers, SHEET, "left_anti")
            .select("file", "sheet", F.lit("header row not found").alias("error")))


def header_cells(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """The header row's cells as ``file, sheet, col_idx, name`` (names stripped, H8;
    blank names dropped, T22)."""
    # equi-join on the header row itself: the join key is row-level, so a very large sheet
    # is not one join key
    at_header = headers.select(*SHEET, F.col("header_row").alias("row_idx"))
    return (non_blank(cells).join(at_header, [*SHEET, "row_idx"])
            .select(*SHEET, "col_idx", strip(F.col("value")).alias("name"))
            .where(F.col("name") != ""))


def _row_block():
    return F.shiftright("row_idx", ROW_BLOCK_BITS).alias("_tly_rows")


def _per_block(per_sheet: DataFrame, cells: DataFrame) -> DataFrame:
    """``per_sheet`` once for each block of rows its sheet has, so that joining it with the
    sheet's rows on (file, sheet, block) has no hot key, however large a sheet is."""
    return per_sheet.join(non_blank(cells).select(*SHEET, _row_block()).distinct(), SHEET)


def table_cells(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """H3 + J6: cells below the header row, labelled with their column's header name
    (null for columns without a header cell)."""
    names = header_cells(cells, headers)
    body = (non_blank(cells).select("*", _row_block()).join(_per_block(headers, cells), [*SHEET, "_tly_rows"])
            .where(F.col("row_idx") > F.col("header_row")).drop("header_row", "_tly_rows"))
    return body.join(names, [*SHEET, "col_idx"], "left")


def alias_table(spark: SparkSession, canonical=config.CANONICAL_ALIASES) -> DataFrame:
    """Alias -> canonical column with priority (fixed size; safe to broadcast)."""
    rows = [(alias, canon, prio) for canon, aliases in canonical.items() for prio, alias in enumerate(aliases)]
    return spark.createDataFrame(rows, "alias string, canonical string, priority int")


def column_map(cells: DataFrame, headers: DataFrame, canonical=config.CANONICAL_ALIASES,
               date_col: str | None = "voucher_date", date_fallback: int = config.DATE_FALLBACK_COL_IDX,
               normalise: bool = False) -> DataFrame:
    """H7 across sheets: per sheet, the grid column of every canonical column -- the
    highest-priority alias present, first column for duplicates (T22); when no date alias
    is present the date comes from grid column ``date_fallback``.

    Output: one row per sheet, ``file, sheet, header_row, cols, names`` with ``cols`` a
    map canonical -> col_idx and ``names`` a map col_idx -> header name (all named columns).
    """
    spark = cells.sparkSession
    aliases = alias_table(spark, canonical)
    key = F.col("name")
    if normalise:
        # H6: compare normalised names (trim, lower case, punctuation removed)
        key = norm_name(key)
        aliases = aliases.withColumn("alias", norm_name(F.col("alias")))
    # the header cells are read once: canonical columns and all named cells (col_idx -> name)
    # come from the same two aggregates; a sheet has as many as it is wide
    named = header_cells(cells, headers).withColumn("_tly_key", key)
    picked = (named.join(F.broadcast(aliases), F.col("_tly_key") == F.col("alias"), "left")
              .groupBy(*SHEET, "canonical")
              .agg(F.min_by("col_idx", F.struct("priority", "col_idx")).alias("col_idx"),
                   F.collect_set(F.struct("col_idx", "name")).alias("named")))
    canon = F.when(F.col("canonical").isNotNull(), F.struct("canonical", "col_idx"))
    per_sheet = picked.groupBy(*SHEET).agg(
        F.map_from_entries(F.collect_list(canon)).alias("cols"),
        F.map_from_entries(F.array_distinct(F.flatten(F.collect_list("named")))).alias("names"))
    with_date = (headers.join(per_sheet, SHEET, "left")
                 .withColumn("cols", F.coalesce(F.col("cols"), F.create_map().cast("map<string,int>")))
                 .withColumn("names", F.coalesce(F.col("names"), F.create_map().cast("map<int,string>"))))
    if date_col is None:
        return with_date
    has_date = F.col("cols").getItem(date_col).isNotNull()
    fallback = F.map_concat(F.col("cols"), F.create_map(F.lit(date_col), F.lit(date_fallback)))
    return with_date.withColumn("cols", F.when(has_date, F.col("cols")).otherwise(fallback))


def sheet_rows_wide(cells: DataFrame, colmap: DataFrame, canonical=config.CANONICAL_ALIASES,
                    per_sheet: tuple[str, ...] = ()) -> DataFrame:
    """H3 + H4 + pivot: one row per non-blank grid row below the header, one column per
    canonical name (raw text); ``per_sheet`` names further columns of ``colmap`` to carry.

    Cells are first grouped per grid row -- a group is one row's cells, bounded by the
    sheet width -- and only then joined with the column map, by blocks of rows, so a very
    large sheet is never gathered into one task.
    """
    extra = ["folder"] if "folder" in cells.columns else []
    grid_rows = (non_blank(cells)
                 .groupBy(*SHEET, "row_idx")
                 .agg(F.map_from_entries(F.collect_list(F.struct("col_idx", "value"))).alias("_tly_cells"),
                      *[F.first(c, ignorenulls=True).alias(c) for c in extra]))
    joined = grid_rows.select("*", _row_block()).join(_per_block(colmap, cells), [*SHEET, "_tly_rows"]).where(F.col("row_idx") > F.col("header_row"))
    wide = [F.try_element_at(F.col("_tly_cells"), F.try_element_at(F.col("cols"), F.lit(c))).alias(c)
            for c in canonical]
    # named columns that are not canonical stay with the row as header name -> value
    # (unnamed columns are dropped, like the original's 'Unnamed' columns)
    used = F.map_values(F.col("cols"))
    kept = F.map_filter(F.col("_tly_cells"), lambda k, v: ~F.array_contains(used, k)
                        & F.try_element_at(F.col("names"), k).isNotNull())
    # a header that an earlier column of the sheet has too gets a number, so no value is lost
    def unique(k):
        name = F.try_element_at(F.col("names"), k)
        earlier = F.size(F.map_filter(F.col("names"), lambda c, n: (c < k) & (n == name)))
        return F.when(earlier > 0, F.concat(name, F.lit("."), earlier.cast("string"))).otherwise(name)
    other = F.transform_keys(kept, lambda k, v: unique(k)).alias("other_columns")
    return joined.select(*SHEET, *extra, *per_sheet, "row_idx", *wide, other)
