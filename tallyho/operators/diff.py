"""Table diff: multiset row diff and cell-level diff of two versions of a table.

Rows are compared in their normalised text form (D2/F3).  With keys, the t-th row of a key
on the left is paired with the t-th row of that key on the right (t = occurrence number
in a caller-given order); unpaired rows are the left-only / right-only surplus.  Without
keys, whole rows are anti-joined in both directions.

Scale: the occurrence number comes from ``skew.occurrence_number`` (no per-key task), and
rows are paired on ``(keys, occurrence)``, which is unique per row.  What belongs to a key as
a whole (its counts) meets the key's rows by blocks of ``KEY_BLOCK`` occurrences, so a hot
key is split there too; the sizes behind a pair's multiplicity come with the numbering.
Values go through shuffles in their own type where that is as good as their text.  The
keyless diff compares digests of buckets of rows first; only rows of buckets that differ
are shuffled, once, for both directions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.dates import SHEET_DATE_FORMATS, excel_serial_to_date, sheet_date
from ..functions.text import norm_text, strip
from ..session import landed
from .columns import shared_column
from .skew import expand_copies, occurrence_number

KEY_BLOCK = 1 << 16   # occurrences of a key that meet its counts in one task

FEW = 1 << 10         # copies of one row that are written out where the row lies

OCC = "_tly_occ"
SIZE = "_tly_size"
BLOCK = "_tly_key_block"
SUMS = [f"_tly_s{i}" for i in range(5)]
SHARES = "column string, filled long, layouts array<long>, serials long"
TEMPORAL = ("date", "timestamp", "timestamp_ntz")


def _normalised(df: DataFrame, date_cols=(), case_insensitive: bool = False) -> list:
    out = []
    for c, t in df.dtypes:
        col = F.col(f"`{c}`")
        if t in TEMPORAL:
            e = F.coalesce(F.date_format(col, "yyyy-MM-dd"), F.lit(""))
        elif c in date_cols:
            e = F.coalesce(F.date_format(sheet_date(col), "yyyy-MM-dd"), norm_text(col, case_insensitive))
        else:
            e = norm_text(col, case_insensitive)
        out.append(e.alias(c))
    return out


def normalise_for_diff(df: DataFrame, date_cols=(), case_insensitive: bool = False) -> DataFrame:
    """D2 + F3: every column as comparable text.

    Temporal columns and the declared ``date_cols`` (text parsed with D1) print as
    'yyyy-MM-dd' (unparseable text is kept as text); everything else is stripped,
    optionally lower-cased, and null becomes ''.  Numbers are compared as their text
    form, never as Excel serial dates (T9).
    """
    return df.select(*_normalised(df, date_cols, case_insensitive))


# types whose values differ exactly when their text forms do (strings are stripped and
# lower-cased, doubles have -0.0); null, which prints as '', is told apart too
_EXACT_TYPES = ("tinyint", "smallint", "int", "bigint", "boolean", "date")


def _typed(left: DataFrame, right: DataFrame, date_cols=()) -> set[str]:
    """Columns whose values can be compared before they are printed: of one type on both sides."""
    lt, rt = dict(left.dtypes), dict(right.dtypes)
    return {c for c, t in lt.items() if rt.get(c) == t and (t == "timestamp" or c not in date_cols and (
        t in _EXACT_TYPES or t.startswith("decimal")))}


def _comparable(df: DataFrame, typed: set[str], date_cols, case_insensitive) -> dict:
    """Every column as it is compared: ``typed`` ones as values, a timestamp as its day, others printed."""
    texts = dict(zip(df.columns, _normalised(df, date_cols, case_insensitive)))
    return {c: (F.to_date(F.col(f"`{c}`")) if t == "timestamp" else F.col(f"`{c}`")) if c in typed else texts[c]
            for c, t in df.dtypes}


def _printed(col: Column, dtype: str, case_insensitive: bool) -> Column:
    """A ``typed`` column's text form; ``dtype`` is what it was read as."""
    return F.coalesce(F.date_format(col, "yyyy-MM-dd"), F.lit("")) if dtype in TEMPORAL else norm_text(col, case_insensitive)


def date_shares(df: DataFrame) -> DataFrame:
    """For every text column its filled values, those written as a date (a column for each
    layout of D1) and those that are a serial day number; all columns in one aggregate.  A row a column."""
    texts = [c for c, t in df.dtypes if t == "string"]
    if not texts:
        return df.sparkSession.createDataFrame([], SHARES)
    counts = []
    for i, c in enumerate(texts):
        s = strip(F.col(f"`{c}`"))
        counts.append(F.count_if(s != "").alias(f"_tly_f{i}"))
        counts += [F.count_if(F.try_to_timestamp(s, F.lit(layout)).isNotNull()).alias(f"_tly_l{i}_{j}")
                   for j, layout in enumerate(SHEET_DATE_FORMATS)]
        counts.append(F.count_if(excel_serial_to_date(s).isNotNull()).alias(f"_tly_n{i}"))
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"_tly_f{i}").alias("filled"),
                     F.array(*[F.col(f"_tly_l{i}_{j}") for j in range(len(SHEET_DATE_FORMATS))]).alias("layouts"),
                     F.col(f"_tly_n{i}").alias("serials")) for i, c in enumerate(texts)]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def date_columns(*sides: DataFrame, share: float = 1.0, written: float = 0.5) -> list[str]:
    """The text columns that hold dates, judged by all values of all sides together.

    At least ``share`` of a column's filled values must be dates or serial day numbers and at
    least ``written`` of them written dates, so a column of numbers is never one (T9).  Blank
    columns are none.  Only counts, a row a column, come to the driver.
    """
    tables = [date_shares(df) for df in sides]
    total = reduce(DataFrame.unionByName, tables).groupBy("column").agg(
        F.sum("filled").alias("filled"), F.sum("serials").alias("serials"),
        F.sum(F.aggregate("layouts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("dates"))
    n, d = F.col("filled"), F.col("dates")
    return sorted(r.column for r in total.where((n > 0) & (d + F.col("serials") >= n * share) & (d >= n * written) & (d > 0))
                  .select("column").collect())


def pick_keys(left_cols: list[str], right_cols: list[str],
              groups=None) -> tuple[list[str], list[str]]:
    """From each candidate group, the first name present on both sides (case-insensitive)."""
    if groups is None:
        groups = [config.KEY_GROUP1_FIRST + config.KEY_CANDIDATE_GROUPS[0], *config.KEY_CANDIDATE_GROUPS[1:]]
    found = [hit for group in groups if (hit := shared_column(left_cols, right_cols, group))]
    return [left for left, _ in found], [right for _, right in found]


@dataclass
class DiffResult:
    keys: list[str]
    only_left: DataFrame
    only_right: DataFrame
    cells: DataFrame
    pairs: DataFrame


# key types whose text form is injective, so grouping raw values equals grouping their
# normalised text (strings are not: strip/lower-case can merge them; doubles have -0.0)
_RAW_KEY_TYPES = ("tinyint", "smallint", "int", "bigint", "boolean", "date", "timestamp", "timestamp_ntz")


def _numbered(df: DataFrame, keys: list[str], order: list[str], date_cols, case_insensitive) -> DataFrame:
    """Raw rows plus their occurrence number within the key and the key's size; the position
    inside a key follows the raw (typed) values of ``order``.

    The numbering shuffles the raw typed rows (narrower than their text form, and the
    range sampler does not have to compute the normalisation); the text form is
    computed afterwards.  Keys are normalised first only when raw grouping could differ.
    """
    dtypes = dict(df.dtypes)
    by = [F.col(f"`{c}`") for c in order]
    raw_keys = all(dtypes[k] in _RAW_KEY_TYPES or dtypes[k].startswith("decimal") for k in keys) \
        and not set(keys) & set(date_cols)
    if raw_keys:
        return occurrence_number(df, keys, by, out_col=OCC, size_col=SIZE)
    normalised = dict(zip(df.columns, _normalised(df, date_cols, case_insensitive)))
    norm_keys = [f"_tly_k{i}" for i in range(len(keys))]
    staged = df.select("*", *[normalised[k].alias(nk) for k, nk in zip(keys, norm_keys)])
    return occurrence_number(staged, norm_keys, by, out_col=OCC, size_col=SIZE)


def _per_block(counts: DataFrame, up_to) -> DataFrame:
    """Rows of a table with a row a key, once for each block of occurrences from 1 to ``up_to``."""
    return counts.withColumn(BLOCK, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((up_to - 1) / KEY_BLOCK))))


def _blocked(df: DataFrame) -> DataFrame:
    return df.withColumn(BLOCK, F.floor((F.col(OCC) - 1) / KEY_BLOCK))


def diff_by_keys(left: DataFrame, right: DataFrame, keys: list[str], order: list[str] | None = None,
                 right_order: list[str] | None = None, date_cols=(), case_insensitive: bool = False,
                 surplus: str = "unpaired") -> DiffResult:
    """J2 + J3 + J5 + W2: keyed multiset diff.

    ``order`` (default: all left columns) decides which rows of a key are the 1st, 2nd, ...
    ``surplus="unpaired"`` reports the rows that found no partner; ``"first"`` reports the
    first n rows of a key with n surplus rows (the original tool's choice).
    """
    for side, df in (("left", left), ("right", right)):
        missing = [k for k in keys if k not in df.columns]
        if missing:
            raise ValueError(f"{side}: key columns {missing} not found")
    order = order or left.columns
    right_order = right_order or [c for c in order if c in right.columns] or right.columns
    nl = _numbered(left, keys, order, date_cols, case_insensitive)
    nr = _numbered(right, keys, right_order, date_cols, case_insensitive)
    L = nl.select(*_normalised(left, date_cols, case_insensitive), OCC)
    R = nr.select(*_normalised(right, date_cols, case_insensitive), OCC)
    on = [*keys, OCC]
    if surplus == "unpaired":
        only_left = L.join(R.select(*on), on, "left_anti")
        only_right = R.join(L.select(*on), on, "left_anti")
    elif surplus == "first":
        # Multiset key counts per side (partial aggregation)
        cl = L.groupBy(*keys).agg(F.count(F.lit(1)).alias("_tly_nl"))
        cr = R.groupBy(*keys).agg(F.count(F.lit(1)).alias("_tly_nr"))
        counts = cl.join(cr, keys, "full").fillna(0, ["_tly_nl", "_tly_nr"])

        def first(rows, own, other):
            spare = (F.col(own) - F.col(other)).alias("_tly_spare")
            over = _per_block(counts.select(*keys, spare).filter("_tly_spare > 0"), F.col("_tly_spare"))
            return (_blocked(rows).join(over, [*keys, BLOCK]).where(F.col(OCC) <= F.col("_tly_spare"))
                    .drop("_tly_spare", BLOCK))
        only_left, only_right = first(L, "_tly_nl", "_tly_nr"), first(R, "_tly_nr", "_tly_nl")
    else:
        raise ValueError("surplus must be 'unpaired' or 'first'")
    common = [c for c in sorted(set(left.columns) & set(right.columns)) if c not in keys]
    typed = _typed(left, right, date_cols) - set(keys)

    def side(numbered, df, mark):
        form = _comparable(df, typed, date_cols, case_insensitive)
        return numbered.select(*[form[k] for k in keys], OCC, F.col(SIZE).alias(f"_tly_size_{mark}"),
                               *[form[c].alias(f"_tly_{mark}{i}") for i, c in enumerate(common)])

    pairs = side(nl, left, "l").join(side(nr, right, "r"), on)
    if common:
        dtypes = dict(left.dtypes)

        def value(mark, i, c):
            col = F.col(f"_tly_{mark}{i}")
            return _printed(col, dtypes[c], case_insensitive) if c in typed else col

        differ = [~F.col(f"_tly_l{i}").eqNullSafe(F.col(f"_tly_r{i}")) for i in range(len(common))]
        cells_arr = F.array(*[F.when(differ[i], F.struct(F.lit(c).alias("column"), value("l", i, c).alias("left_value"),
                                                         value("r", i, c).alias("right_value")))
                              for i, c in enumerate(common)])
        # Each difference once per paired row; ``multiplicity`` = paired rows of the key,
        # whose occurrences are 1, 2, ... on both sides: the smaller of its sizes
        cells = (pairs.where(reduce(lambda a, b: a | b, differ))
                 .select(*[F.col(k).alias(f"key_{j + 1}") for j, k in enumerate(keys)],
                         F.inline(F.filter(cells_arr, lambda x: x.isNotNull())),
                         F.least("_tly_size_l", "_tly_size_r").alias("multiplicity")))
    else:
        cells = pairs.select(*[F.col(k).alias(f"key_{j + 1}") for j, k in enumerate(keys)],
                             F.lit(None).cast("string").alias("column"),
                             F.lit(None).cast("string").alias("left_value"),
                             F.lit(None).cast("string").alias("right_value"),
                             F.lit(None).cast("long").alias("multiplicity")).where(F.lit(False))
    return DiffResult(keys, only_left.drop(OCC), only_right.drop(OCC), cells, pairs)


def diff_rows(left: DataFrame, right: DataFrame, case_insensitive: bool = False, buckets: int = 1 << 20,
              date_cols=()) -> tuple[DataFrame, DataFrame]:
    """J4 + U4: keyless diff -- rows of one side whose whole normalised row is absent on
    the other side, duplicates kept; columns aligned by name, missing ones as ''.

    Columns of one exact type on both sides are compared as values and printed at the end.
    Rows fall into buckets by a hash.  Per bucket and side one aggregate holds the row count
    and the sums of the four 32-bit parts of the rows' 128-bit digests; sums do not depend on
    an order and, unlike xor, do not cancel copies.  A bucket whose aggregates agree holds the
    same rows on both sides, so only rows of the others are shuffled and compared as a whole.
    The list of differing buckets (broadcast) has at most ``buckets`` numbers.
    """
    cols = sorted(set(left.columns) | set(right.columns))
    names = [F.col(f"`{c}`") for c in cols]

    typed = _typed(left, right, date_cols)
    # a hash passes over nulls, so where they are is hashed too
    hashed = [*names, *[F.col(f"`{c}`").isNull() for c in cols if c in typed]]

    def aligned(df):
        form = _comparable(df, typed, date_cols, case_insensitive)
        rows = df.select(*[(form[c] if c in form else F.lit("")).alias(c) for c in cols])
        digest = rows.select("*", F.xxhash64(*hashed).alias("_tly_d1"), F.xxhash64(F.lit("#"), *hashed).alias("_tly_d2"))
        return digest.withColumn("_tly_bucket", F.pmod(F.col("_tly_d1"), F.lit(buckets)).cast("int"))

    def digests(rows, sign):
        half = [F.expr(f"{d} & 4294967295").alias(f"{d}l") for d in ("_tly_d1", "_tly_d2")] + \
               [F.expr(f"shiftrightunsigned({d}, 32)").alias(f"{d}h") for d in ("_tly_d1", "_tly_d2")]
        return rows.select("_tly_bucket", *[(c * sign) for c in (*half, F.lit(1).cast("long"))]).toDF("_tly_bucket", *SUMS)

    L, R = aligned(left), aligned(right)
    both = digests(L, 1).union(digests(R, -1)).groupBy("_tly_bucket").agg(*[F.sum(c).alias(c) for c in SUMS])
    # landed: both directions and both sides read it; its size is bounded by ``buckets``
    differing = landed(both.filter(" or ".join(f"{c} <> 0" for c in SUMS)).select("_tly_bucket"), "differing")

    def suspects(rows, l, r):
        return (rows.join(F.broadcast(differing), "_tly_bucket", "left_semi")
                .select(*names, F.lit(l).cast("long").alias("_tly_l"), F.lit(r).cast("long").alias("_tly_r")))

    # one shuffle of both sides; a pile of identical copies collapses in the map-side partial
    # aggregate.  Landed: both directions read it, and it has only rows that one side lacks
    counted = suspects(L, 1, 0).union(suspects(R, 0, 1)).groupBy(*names).agg(F.sum("_tly_l").alias("_tly_l"), F.sum("_tly_r").alias("_tly_r"))
    alone = landed(counted.filter("_tly_l = 0 or _tly_r = 0"), "alone")
    dtypes = dict(left.dtypes)
    printed = [_printed(F.col(f"`{c}`"), dtypes[c], case_insensitive).alias(c) if c in typed else F.col(f"`{c}`") for c in cols]

    def absent(n):
        # few copies are written out where they lie, many in chunks that spread over tasks
        few = alone.filter(F.col(n).between(1, FEW)).withColumn("_tly_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(n))))
        many = expand_copies(alone.filter(F.col(n) > FEW), n, "_tly_copy")
        return few.union(many).select(*printed)

    return absent("_tly_l"), absent("_tly_r")


def diff_summary(result: DiffResult, left_name: str = "left", right_name: str = "right") -> DataFrame:
    """One-row summary.  The three counts are one-row aggregates of the diff outputs,
    joined in one plan (so the numbered sides are computed once and reused)."""
    def count(df, name):
        return F.broadcast(df.agg(F.count(F.lit(1)).alias(name)))
    keys_used = ", ".join(result.keys) if result.keys else config.NO_KEYS_LABEL
    nl, nr, nd = F.col("only_in_left_rows"), F.col("only_in_right_rows"), F.col("column_diff_rows")
    return (count(result.only_left, "only_in_left_rows")
            .join(count(result.only_right, "only_in_right_rows"), how="inner", on=F.lit(True))
            .join(count(result.cells, "column_diff_rows"), how="inner", on=F.lit(True))
            .select(F.lit(left_name).alias("left_table"), F.lit(right_name).alias("right_table"),
                    F.lit(keys_used).alias("keys_used"), ((nl == 0) & (nr == 0) & (nd == 0)).alias("same"),
                    nl, nr, nd))


def key_except_all(result: DiffResult) -> DataFrame:
    """Multiset difference of the key columns (left - right), one row per surplus key
    occurrence -- the keys of the unpaired left rows."""
    return result.only_left.select(*result.keys)


def key_intersect_all(result: DiffResult) -> DataFrame:
    """Multiset intersection of the key columns -- one row per paired occurrence."""
    return result.pairs.select(*result.keys)


def diff_report(result: DiffResult, left_name: str = "left", right_name: str = "right") -> dict[str, DataFrame]:
    """K3: the diff report tables (write them with ``sinks.writers.write_report``);
    the cell table is left out when it is empty, as in the original."""
    return {"summary": diff_summary(result, left_name, right_name),
            "only_in_left": result.only_left, "only_in_right": result.only_right,
            "column_diff": result.cells}


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """A10: the set of key tuples (a distinct aggregation, combined map-side)."""
    return df.select(*keys).distinct()
