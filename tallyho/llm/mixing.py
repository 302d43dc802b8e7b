"""Mixing sources to target weights.

Sizes are summed per source, targets and repetition rates follow from the sums, and each
document is taken floor(rate) times plus once more with probability rate - floor(rate),
decided by a seeded hash of its id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import occurrence_number
from .common import WORD_ENDS, landed, neutral


@dataclass(frozen=True)
class Params:
    """``weights`` repeat over the sources by code point, null last.

    The targets share ``share`` times all sizes; none is above ``most`` times its source's size.
    """

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    most: float = 2.0
    seed: str = "mix-1"


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_mix_size``, the number of words of the text (null: 0), and ``_mix_source``.

    A word begins at each character that is no word end but follows one; marking word ends
    with one character and the rest with another leaves words as runs to count.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumns({
        "_mix_size": F.size(F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda x: x != "")).cast("long"),
        "_mix_source": F.col("source").cast("string")})


def targets(sizes: DataFrame, p: Params = Params()) -> DataFrame:
    """``_mix_source, source_size, target, rate`` from rows of ``_mix_source, _mix_size``.

    With sources in order of most * size / weight, those that reach their limit come first:
    after i of them, the rest share what is left by weight.  The first level of sharing at
    which the next source stays within its limit is the one that holds.  The windows run
    over one row a source, aggregated before.
    """
    sums = sizes.groupBy("_mix_source").agg(F.sum("_mix_size").alias("source_size"))
    by_name = Window.orderBy(F.col("_mix_source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in p.weights])
    rows = (sums.withColumn("_n", F.row_number().over(by_name) - 1)
            .withColumn("_w", F.get(weights, F.col("_n") % len(p.weights)))
            .withColumn("_limit", F.col("source_size") * p.most))
    everything = Window.partitionBy(F.lit(1))
    by_level = Window.orderBy(F.col("_limit") / F.col("_w"), "_n")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.withColumns({"_total": F.sum("source_size").over(everything) * p.share, "_weights": F.sum("_w").over(everything),
                              "_full": F.coalesce(F.sum("_limit").over(before), F.lit(0.0)),
                              "_full_w": F.coalesce(F.sum("_w").over(before), F.lit(0.0)),
                              "_at": F.row_number().over(by_level)})
            .withColumn("_level", (F.col("_total") - F.col("_full")) / (F.col("_weights") - F.col("_full_w")))
            .withColumn("_holds", F.min_by("_level", F.when(F.col("_level") * F.col("_w") <= F.col("_limit"), F.col("_at")))
                        .over(everything)))
    target = F.least("_limit", F.coalesce(F.col("_holds") * F.col("_w"), F.col("_limit"))).cast("double")
    return rows.select("_mix_source", "source_size", target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))


def coin(p: Params, name: Column) -> Column:
    """A number from 0 up to 1 from the seed and a name: the same in every run."""
    text = F.concat(F.lit(p.seed + ":"), name)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / float(1 << 32)


def coined(rows: DataFrame, p: Params = Params()) -> DataFrame:
    """``rows`` with ``_mix_coin`` and ``_mix_nth``: a coin an id, and a place among the rows that share the coin.

    A row whose id is null or repeated is named by a digest of id, text and source.  Rows that
    agree in these share a coin and are numbered, a large pile of them in buckets.
    """
    key = F.col("doc_id").cast("string")
    repeated = landed(rows.groupBy(key.alias("_mix_id")).agg(F.count(F.lit(1)).alias("_mix_n"))
                      .filter("_mix_n > 1 or _mix_id is null").select("_mix_id"), "repeated")
    if repeated.isEmpty():
        return rows.withColumns({"_mix_coin": coin(p, key), "_mix_nth": F.lit(1).cast("long")})
    given, same = rows.filter("doc_id is not null"), key == F.col("_mix_id")
    single = given.join(repeated, same, "left_anti").withColumns({"_mix_coin": coin(p, key), "_mix_nth": F.lit(1).cast("long")})
    several = rows.filter("doc_id is null").unionAll(given.join(repeated, same, "left_semi"))
    named = several.withColumns({"_mix_a": F.xxhash64("doc_id", "text", "source"), "_mix_b": F.xxhash64(F.lit(17), "doc_id", "text", "source")})
    numbered = occurrence_number(named, ["_mix_a", "_mix_b"], [], "_mix_nth")
    name = F.concat_ws(":", key, F.col("_mix_a").cast("string"), F.col("_mix_b").cast("string"))
    return single.unionByName(numbered.withColumn("_mix_coin", coin(p, name)).drop("_mix_a", "_mix_b"))


def taken(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``docs`` with ``_mix_size``, ``source_size`` and ``target`` as ``_mix_...``, and ``_mix_times``.

    Of n rows that share a coin, the first i take ceil(i * fraction - coin) copies more in all.

    The targets table has a row a source and is joined by name; a source that holds most
    rows is split by Spark's skew join, or the table is broadcast when measured small.
    """
    rows = sized(docs)
    plan = landed(targets(rows.select("_mix_source", "_mix_size"), p), "targets").select(
        F.col("_mix_source").alias("_mix_of"), F.col("source_size").alias("_mix_source_size"),
        F.col("target").alias("_mix_target"), F.col("rate").alias("_mix_rate"))
    joined = coined(rows, p).join(plan, F.col("_mix_source").eqNullSafe(F.col("_mix_of")))
    whole, nth = F.floor("_mix_rate"), F.col("_mix_nth")
    more = [F.ceil(i * (F.col("_mix_rate") - whole) - F.col("_mix_coin")) for i in (nth, nth - 1)]
    return joined.withColumn("_mix_times", (whole + more[0] - more[1]).cast("long"))


def mix_sizes(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document.

    Null texts have size 0 and so take no words; a null source is a source of its own, the last
    one; rows whose doc_id is null or repeated are taken each on its own, also where they are
    equal.  Other columns are not read.  An empty table gives an empty result.
    """
    return taken(docs.select("doc_id", "text", "source"), p).select(
        "doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"), (F.col("_mix_size") * F.col("_mix_times")).alias("taken"))


def mix(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The mixture itself: each row of ``docs``, all columns, as often as it is taken.

    Rows are treated as in ``mix_sizes``; other columns may have any names.
    """
    rows, back = neutral(docs, "doc_id", "text", "source")
    return back(taken(rows, p).filter("_mix_times > 0")
                .withColumn("_mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix_times")))))
