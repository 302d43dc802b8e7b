"""Spend analysis (entry 3): amounts by payment term (or any dimension), top-k with an
"other" bucket, shares of the grand total, top-3 table and vendor shares inside the top
terms.

Plan shape: one partial/final hash aggregate per dimension; top-k is a distributed
``TakeOrderedAndProject``; the grand total is a one-row aggregate joined back; the only
broadcasts are that row and the top-k / top-3 term lists, whose size is bounded by k.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.text import AMOUNT_TYPE, blank_to_null, is_blank, parse_amount, pct_label, starts_with_subtotal

AMOUNT = "amount"


def _subtotal_hit(df: DataFrame, prefix: str = config.SUBTOTAL_PREFIX):
    """True when any text cell of the row -- text columns and the values of text maps such
    as ``other_columns`` -- starts with the subtotal marker after strip."""
    tests = [starts_with_subtotal(c, prefix) for c, t in df.dtypes if t == "string"]
    tests += [F.coalesce(F.exists(F.map_values(F.col(c)), lambda v: starts_with_subtotal(v, prefix)), F.lit(False))
              for c, t in df.dtypes if t == "map<string,string>"]
    return reduce(lambda a, b: a | b, tests) if tests else None


def drop_subtotal_rows(df: DataFrame, prefix: str = config.SUBTOTAL_PREFIX) -> DataFrame:
    """Drop rows where any text cell, stripped, starts with the subtotal marker."""
    hit = _subtotal_hit(df, prefix)
    return df if hit is None else df.where(~hit)


def drop_blank_rows(df: DataFrame, cols=("doc_date", "term_name", "planned_pay_date")) -> DataFrame:
    """Drop rows where all of ``cols`` are blank -- only when all of them exist."""
    if not all(c in df.columns for c in cols):
        return df
    return df.where(~reduce(lambda a, b: a & b, [is_blank(c) for c in cols]))


def spend_rows(df: DataFrame, dimension: str = "term_name", amount: str = AMOUNT,
               null_category: str = "drop", keep: tuple[str, ...] = ()) -> DataFrame:
    """P2 + P3 + P4 + F4: the cleaned ``(dimension, amount)`` rows that feed every spend table.

    ``keep`` names further columns to carry as they are.

    ``amount`` may be text ('1,500.25') or numeric; it becomes an exact decimal.  Rows without
    an amount are dropped; rows without a category are dropped (``null_category="drop"``)
    or kept as their own group (``"keep"``).
    """
    cleaned = drop_blank_rows(drop_subtotal_rows(df))
    dtype = dict(cleaned.dtypes)[amount]
    amt = parse_amount(amount) if dtype == "string" else F.col(amount).try_cast(AMOUNT_TYPE)
    # P5: only the two columns the aggregates need are kept (Catalyst prunes the scan)
    out = cleaned.select(*keep, blank_to_null(F.col(dimension).cast("string")).alias(dimension), amt.alias(AMOUNT))
    out = out.where(F.col(AMOUNT).isNotNull())
    if null_category == "drop":
        out = out.where(F.col(dimension).isNotNull())
    return out


def quality_counts(df: DataFrame, dimension: str = "term_name", amount: str = AMOUNT) -> DataFrame:
    """How many rows each cleaning step drops, in one aggregate."""
    hit = _subtotal_hit(df)
    subtotal = hit if hit is not None else F.lit(False)
    dtype = dict(df.dtypes)[amount]
    amt = parse_amount(amount) if dtype == "string" else F.col(amount)
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_if(subtotal).alias("subtotal_rows"),
                  F.count_if(~subtotal & (blank_to_null(F.col(dimension).cast("string")).isNull() | amt.isNull()))
                  .alias("missing_category_or_amount"))


def sum_by(rows: DataFrame, dimension: str = "term_name") -> DataFrame:
    """Exact sum of amount per dimension value."""
    return rows.groupBy(dimension).agg(F.sum(AMOUNT).alias(AMOUNT))


def _ranked(agg: DataFrame, dimension: str, k: int) -> DataFrame:
    """O3 + O4: the k largest groups, ties broken by name (a bounded TakeOrderedAndProject)."""
    return agg.orderBy(F.desc(AMOUNT), F.asc_nulls_last(dimension)).limit(k)


def with_share(agg: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """A3: share of the grand total in percent (null when the total is 0).

    The total is a one-row aggregate joined back through a broadcast (bounded: one row);
    it stays in the same plan as ``agg``, so their common input is computed once.
    """
    totals = totals if totals is not None else agg
    one = F.broadcast(totals.agg(F.sum(AMOUNT).alias("_tly_total")))
    return (agg.join(one, how="inner", on=F.lit(True))
            .withColumn("pct", F.try_divide(F.col(AMOUNT).cast("double") * 100.0, F.col("_tly_total").cast("double")))
            .drop("_tly_total"))


def spend_by(df: DataFrame, dimension: str = "term_name", amount: str = AMOUNT,
             null_category: str = "drop") -> DataFrame:
    """A1 + A3 + P9: amount and share per group, with the chart label text."""
    rows = spend_rows(df, dimension, amount, null_category)
    agg = sum_by(rows, dimension)
    return (with_share(agg)
            .withColumn(AMOUNT, F.col(AMOUNT).cast("double"))
            .withColumn("label", pct_label(F.col("pct"), config.PCT_LABEL_MIN_TERM)))


def top_k_with_other(df: DataFrame, dimension: str = "term_name", k: int = config.TOP_K,
                     other_label: str = config.OTHER_LABEL, amount: str = AMOUNT,
                     null_category: str = "drop") -> DataFrame:
    """A2 + A3: the k largest groups ranked 1..k, plus one ``other`` row (rank k+1) holding
    the rest -- only when there are more than k groups.  Shares are of the grand total."""
    rows = spend_rows(df, dimension, amount, null_category)
    agg = sum_by(rows, dimension)
    top = _ranked(agg, dimension, k)
    # k rows at most: a proven bound for the broadcast and for the unpartitioned window
    top_keys = F.broadcast(top.select(F.col(dimension).alias("_tly_top")))
    tail = (agg.join(top_keys, agg[dimension].eqNullSafe(F.col("_tly_top")), "left_anti")
            .agg(F.sum(AMOUNT).alias(AMOUNT), F.count(F.lit(1)).alias("_n")))
    other = tail.where(F.col("_n") > 0).select(F.lit(other_label).alias(dimension), AMOUNT,
                                               F.lit(k + 1).alias("rank"))
    ranked = top.withColumn("rank", F.row_number().over(
        Window.orderBy(F.desc(AMOUNT), F.asc_nulls_last(dimension))))
    return (with_share(ranked.unionByName(other), agg)
            .select("rank", dimension, F.col(AMOUNT).cast("double").alias(AMOUNT), "pct"))


def top_k_by_group(df: DataFrame, group: str, dimension: str = "term_name", k: int = config.TOP_K,
                   other_label: str = config.OTHER_LABEL, amount: str = AMOUNT,
                   null_category: str = "drop") -> DataFrame:
    """K4 + A2 + A3: ``top_k_with_other`` of every group (a folder) at once; shares are of the group's own total.

    Ranking stops at k in every task before rows are shuffled to their group (a window
    group limit), so a group of any size sends k rows a task; the rest of a group is its
    total less its top.  A null group is a group; a group without rows left is not in the result.
    """
    agg = spend_rows(df, dimension, amount, null_category, keep=(group,)).groupBy(group, dimension).agg(F.sum(AMOUNT).alias(AMOUNT))
    order = Window.partitionBy(group).orderBy(F.desc(AMOUNT), F.asc_nulls_last(dimension))
    top = agg.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    shown = top.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("rank", dimension, AMOUNT))).alias("_tly_top"),
                                   F.sum(AMOUNT).alias("_tly_shown"))
    totals = agg.groupBy(F.col(group).alias("_tly_group")).agg(F.sum(AMOUNT).alias("_tly_total"), F.count(F.lit(1)).alias("_tly_n"))
    rest = F.struct(F.lit(k + 1).alias("rank"), F.lit(other_label).alias(dimension),
                    (F.col("_tly_total") - F.col("_tly_shown")).cast(agg.schema[AMOUNT].dataType).alias(AMOUNT))
    rows = F.when(F.col("_tly_n") > k, F.concat("_tly_top", F.array(rest))).otherwise(F.col("_tly_top"))
    return (shown.join(totals, F.col(group).eqNullSafe(F.col("_tly_group")))
            .select(group, "_tly_total", F.explode(rows).alias("_tly_row"))
            .select(group, "_tly_row.rank", f"_tly_row.{dimension}", F.col(f"_tly_row.{AMOUNT}").cast("double").alias(AMOUNT),
                    F.try_divide(F.col(f"_tly_row.{AMOUNT}").cast("double") * 100.0, F.col("_tly_total").cast("double")).alias("pct")))


def top_terms(df: DataFrame, n: int = config.TOP_TERMS, dimension: str = "term_name",
              amount: str = AMOUNT) -> DataFrame:
    """A4 + W3 + M1: rank, term, amount and share rounded half-even to one decimal."""
    rows = spend_rows(df, dimension, amount)
    agg = sum_by(rows, dimension)
    top = _ranked(agg, dimension, n)
    return (with_share(top, agg)
            .withColumn("rank", F.row_number().over(Window.orderBy(F.desc(AMOUNT), F.asc_nulls_last(dimension))))
            .select("rank", dimension, F.col(AMOUNT).cast("double").alias(AMOUNT),
                    F.bround("pct", 1).alias("pct")))


def vendor_share(df: DataFrame, n: int = config.TOP_TERMS, dimension: str = "term_name",
                 vendor: str = "vendor_name", amount: str = AMOUNT) -> DataFrame:
    """A5 + P7 + W4: vendor amounts and shares inside each of the top-n terms.

    The base of a share is the term's own vendor total; a non-positive base gives 0.
    The top terms are a left-semi broadcast join (n rows), not a loop over terms.
    """
    rows = spend_rows(df, dimension, amount)
    top = _ranked(sum_by(rows, dimension), dimension, n).select(dimension)
    cleaned = drop_blank_rows(drop_subtotal_rows(df))
    dtype = dict(cleaned.dtypes)[amount]
    amt = parse_amount(amount) if dtype == "string" else F.col(amount).try_cast(AMOUNT_TYPE)
    detail = (cleaned.select(blank_to_null(F.col(dimension).cast("string")).alias(dimension),
                             blank_to_null(F.col(vendor).cast("string")).alias(vendor), amt.alias(AMOUNT))
              .join(F.broadcast(top), dimension, "left_semi")
              .where(F.col(vendor).isNotNull() & F.col(AMOUNT).isNotNull()))
    by_vendor = detail.groupBy(dimension, vendor).agg(F.sum(AMOUNT).alias(AMOUNT))
    # per-term base: an aggregate of the (term, vendor) aggregate, at most n rows
    base = by_vendor.groupBy(dimension).agg(F.sum(AMOUNT).alias("_tly_base"))
    share = F.when(F.col("_tly_base") > 0,
                   F.col(AMOUNT).cast("double") * 100.0 / F.col("_tly_base").cast("double")).otherwise(F.lit(0.0))
    return (by_vendor.join(F.broadcast(base), dimension)
            .select(dimension, vendor, F.col(AMOUNT).cast("double").alias(AMOUNT), share.alias("pct"))
            .withColumn("label", pct_label(F.col("pct"), config.PCT_LABEL_MIN_VENDOR)))
