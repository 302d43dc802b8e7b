"""Per-key positional operators that survive hot keys.

``row_number() OVER (PARTITION BY k ORDER BY o)`` and a forward fill over ``PARTITION BY
sheet`` put every row of one key into one task.  When a key, a sheet or a group of copies
holds a third of the data that task is the job.  The operators below compute the same
values without ever collecting a key into one task:

* ``occurrence_number`` -- 1-based position of a row within its key, in a given order.
  Hot keys are cut into buckets of the order at measured quantiles; rows are numbered
  inside a bucket and shifted by the sizes of the key's earlier buckets.
* ``global_index`` -- the same over the whole table: the position of a row after a sort.
* ``fill_down`` -- last non-null value so far within a group, ordered by a numeric
  position.  Rows are cut into fixed-size blocks; the window runs per (group, block) and
  a small per-block table carries the last value into the following blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import landed

GROUP_ROWS = 1 << 14   # rows of a key that one window may hold before the key is cut into buckets
MAX_BUCKETS = 1 << 12  # buckets of all hot keys together: the bound of the tables that are broadcast
HITS = 64              # sampled rows that stand for one bucket
COPY_CHUNK = 1 << 16   # copies of one row that a task writes at once


def _hashable(df: DataFrame) -> list[Column]:
    return [F.to_json(F.col(f"`{c}`")) if "map<" in t else F.col(f"`{c}`") for c, t in df.dtypes]


def _first_not_below(bounds: Column, value: Column, most: int) -> Column:
    """How many of the ascending ``bounds`` are below ``value``, by halving (at most ``most`` bounds)."""
    def halve(s, _):
        mid = F.floor((s.lo + s.hi) / 2).cast("int")
        below = F.get(bounds, mid) < value
        return F.when(s.lo >= s.hi, s).otherwise(F.struct(F.when(below, mid + 1).otherwise(s.lo).alias("lo"),
                                                          F.when(below, s.hi).otherwise(mid).alias("hi")))
    steps = F.array(*[F.lit(i) for i in range(most.bit_length())])
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi")), halve)["lo"]


def expand_copies(df: DataFrame, count_col: str, number_col: str, chunk: int = COPY_CHUNK) -> DataFrame:
    """Each row ``count_col`` times, numbered 1, 2, ... in ``number_col``; chunks of a row's copies spread over tasks."""
    last = F.expr(f"(`{count_col}` - 1) div {chunk}")
    chunks = (df.filter(F.col(count_col) > 0)
              .withColumn("_tly_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
              .repartition(*[c for c in _hashable(df)], "_tly_chunk"))
    start = F.col("_tly_chunk") * chunk
    return (chunks.withColumn(number_col, F.explode(F.sequence(start + 1, F.least(start + chunk, F.col(count_col)))))
            .drop("_tly_chunk"))


def occurrence_number(df: DataFrame, keys: list[str], order: list, out_col: str = "occ",
                      group_rows: int = GROUP_ROWS, size_col: str | None = None) -> DataFrame:
    """Add ``out_col`` = ``row_number() over (partition by keys order by order)``, and the
    number of the key's rows as ``size_col`` if one is named.

    ``order`` (names or expressions, ascending, nulls first) decides the position inside a
    key, a hash of the row breaks ties; rows that tie on that too are equal, and which of
    them gets which number cannot be told.  Null keys are one key.  ``df`` must give the
    same rows whenever it is computed; it is read up to four times.

    A table of at most ``group_rows`` rows, and every key that is not hot, is one window.
    Hot keys are found in a sample, which only decides how well buckets balance: a key's
    bucket bounds are every ``HITS``-th of its sampled (order, hash) tuples.  Bounds are
    written once, so a row's bucket depends on the row alone and passes agree however often
    they are computed again.  Rows that equal a bound -- a pile of copies makes itself one --
    are a bucket of their own: they are collapsed before the shuffle and written out from
    their count.  The two tables that are broadcast have at most one row a hot key and two a
    bound; there are about ``MAX_BUCKETS`` bounds, whatever the rows.
    """
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    cols = [F.col(f"`{c}`") for c in df.columns]
    hashed = _hashable(df)
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(by)], F.xxhash64(*hashed).alias("h1"),
                     F.xxhash64(F.lit(17), *hashed).alias("h2"))
    key = F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)], F.lit(0).alias("all"))
    parts = [F.col(f"`{k}`") for k in keys] or [F.lit(0)]
    # the order of ``place``, column by column
    sorting = [*by, F.xxhash64(*hashed), F.xxhash64(F.lit(17), *hashed)]

    def together(rows, *group):
        # dealt out before the window, so that what the window sorts by is computed behind the
        # shuffle and not carried through it
        return rows.repartition(*group) if keys or len(group) > 1 else rows

    def size(count, name="_tly_size"):
        return [count.cast("long").alias(name)] if size_col else []

    def plain(rows):
        w = Window.partitionBy(*parts)
        return together(rows, *parts).select(*cols, F.row_number().over(w.orderBy(*sorting)).cast("long").alias(out_col),
                                             *size(F.count(F.lit(1)).over(w), size_col))

    n = df.count()
    if n <= group_rows:
        return plain(df)
    share = max(group_rows, n / MAX_BUCKETS)
    hits = min(HITS, group_rows)
    picked = df.select(key.alias("_tly_key"), place.alias("_tly_place")).sample(min(1.0, hits / share), 7)
    tuples = F.sort_array(F.collect_list("_tly_place"))
    bounds = F.array_distinct(F.filter(F.col("_tly_all"), lambda x, i: i % hits == hits - 1))
    hot = landed(picked.groupBy("_tly_key").agg(tuples.alias("_tly_all")).filter(F.size("_tly_all") >= hits)
                 .select(F.col("_tly_key").alias("_tly_hot"), bounds.alias("_tly_bounds")), "bounds")
    if hot.isEmpty():
        return plain(df)

    most = int(n / share) + 2 if share > hits else n
    at = _first_not_below(F.col("_tly_bounds"), place, most)
    cut = (df.join(F.broadcast(hot), key == F.col("_tly_hot"), "left").withColumn("_tly_at", at)
           .withColumn("_tly_pile", F.coalesce(F.get("_tly_bounds", F.col("_tly_at")) == place, F.lit(False)))
           .withColumn("_tly_bucket", F.when(F.col("_tly_bounds").isNull(), -1)
                       .otherwise(F.col("_tly_at") * 2 + F.col("_tly_pile").cast("int"))))
    sizes = cut.filter("_tly_bounds is not null").groupBy("_tly_hot", "_tly_bucket").agg(F.count(F.lit(1)).alias("_tly_n"))
    before = Window.partitionBy("_tly_hot").orderBy("_tly_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = landed(sizes.select(F.col("_tly_hot").alias("_tly_of"), F.col("_tly_bucket").alias("_tly_in"),
                                 F.coalesce(F.sum("_tly_n").over(before), F.lit(0)).alias("_tly_shift"),
                                 F.sum("_tly_n").over(Window.partitionBy("_tly_hot")).alias("_tly_all")), "shifts")

    def shifted(rows):
        return rows.join(F.broadcast(shifts), (key == F.col("_tly_of")) & (F.col("_tly_bucket") == F.col("_tly_in")), "left")

    w = Window.partitionBy(*parts, "_tly_bucket")
    single = (shifted(together(cut.filter("not _tly_pile").select(*cols, "_tly_bucket"), *parts, F.col("_tly_bucket"))
                      .select(*cols, "_tly_bucket", F.row_number().over(w.orderBy(*sorting)).alias("_tly_local"),
                              *size(F.count(F.lit(1)).over(w))))
              .select(*cols, (F.coalesce("_tly_shift", F.lit(0)) + F.col("_tly_local")).cast("long").alias(out_col),
                      *size(F.coalesce("_tly_all", "_tly_size") if size_col else None, size_col)))
    piles = cut.filter("_tly_pile").groupBy(*cols, "_tly_bucket").agg(F.count(F.lit(1)).alias("_tly_n"))
    copies = (expand_copies(shifted(piles).select(*cols, "_tly_n", "_tly_shift", "_tly_all"), "_tly_n", "_tly_local")
              .select(*cols, (F.col("_tly_shift") + F.col("_tly_local")).cast("long").alias(out_col),
                      *size(F.col("_tly_all"), size_col)))
    return single.union(copies)


def global_index(df: DataFrame, order: list, out_col: str = "pos", group_rows: int = GROUP_ROWS) -> DataFrame:
    """Add ``out_col`` = the 1-based position of each row after a sort by ``order``, without an unpartitioned window."""
    return occurrence_number(df, [], order, out_col, group_rows)


def fill_down(df: DataFrame, partition_cols: list[str], position_col: str, value_col: str,
              out_col: str | None = None, block_rows: int = 1 << 20) -> DataFrame:
    """Forward fill: last non-null ``value_col`` at or before each row within its group.

    Equivalent to ``last(value, ignorenulls) over (partition by g order by position rows
    between unbounded preceding and current row)``, computed in blocks of ``block_rows``
    positions so that no window partition exceeds one block.
    """
    out_col = out_col or value_col
    block = "_tly_block"
    blk = F.floor(F.col(position_col) / F.lit(block_rows)).cast("long")
    with_block = df.withColumn(block, blk)
    w_local = (Window.partitionBy(*partition_cols, block).orderBy(position_col)
               .rowsBetween(Window.unboundedPreceding, 0))
    local = with_block.withColumn("_tly_local", F.last(value_col, ignorenulls=True).over(w_local))
    # one row per (group, block): the block's last non-null value, or null when the block
    # has none (max_by ignores rows whose ordering value is null); partial aggregation
    per_block = (with_block.groupBy(*partition_cols, block)
                 .agg(F.max_by(value_col, F.when(F.col(value_col).isNotNull(), F.col(position_col)))
                      .alias("_tly_block_last")))
    w_blocks = (Window.partitionBy(*partition_cols).orderBy(block)
                .rowsBetween(Window.unboundedPreceding, -1))
    carry = (per_block.withColumn("_tly_carry_in", F.last("_tly_block_last", ignorenulls=True).over(w_blocks))
             .select(*partition_cols, block, "_tly_carry_in"))
    joined = local.join(carry, [*partition_cols, block], "left")
    result = joined.withColumn(out_col, F.coalesce(F.col("_tly_local"), F.col("_tly_carry_in")))
    keep = [c for c in df.columns if c != out_col] + [out_col]
    return result.select(*keep)


def occurrence_number_unique(df: DataFrame, keys: list[str], order_col: str, out_col: str = "occ",
                             block_width: int = 1 << 20) -> DataFrame:
    """``row_number() over (partition by keys order by order_col)`` when ``order_col`` is a
    unique integer within each key (a primary key, a row index).

    Rows are numbered inside (key, block of ``block_width`` consecutive order values) --
    at most ``block_width`` rows, because the values are unique -- and each block is
    shifted by the row count of the key's earlier blocks (a prefix sum over a table with
    one row per key and block).  No range sampling, no Python; a hot key spreads over
    its blocks.
    """
    block = "_tly_oblock"
    with_block = df.withColumn(block, F.floor(F.col(order_col) / F.lit(block_width)).cast("long"))
    local = with_block.withColumn(
        "_tly_local", F.row_number().over(Window.partitionBy(*keys, block).orderBy(order_col)))
    sizes = with_block.groupBy(*keys, block).agg(F.count(F.lit(1)).alias("_tly_n"))
    w = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_tly_off", F.coalesce(F.sum("_tly_n").over(w), F.lit(0))).drop("_tly_n")
    joined = local.join(offsets, [*keys, block])
    return joined.select(*df.columns, (F.col("_tly_off") + F.col("_tly_local")).cast("long").alias(out_col))
