"""Diff semantics (J2-J5, U2-U3) and the skew-safe positional operators."""
import datetime
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyho.operators import diff
from tallyho.operators.skew import fill_down, occurrence_number


def test_multiset_example(spark):
    left = spark.createDataFrame([("k", "1"), ("k", "2"), ("m", "3")], "key string, v string")
    right = spark.createDataFrame([("k", "1"), ("n", "4")], "key string, v string")
    res = diff.diff_by_keys(left, right, ["key"], order=["v"])
    assert sorted(tuple(r) for r in res.only_left.collect()) == [("k", "2"), ("m", "3")]
    assert [tuple(r) for r in res.only_right.collect()] == [("n", "4")]
    assert res.pairs.count() == 1 and res.cells.count() == 0
    assert sorted(r[0] for r in diff.key_except_all(res).collect()) == ["k", "m"]
    assert [r[0] for r in diff.key_intersect_all(res).collect()] == ["k"]
    first = diff.diff_by_keys(left, right, ["key"], order=["v"], surplus="first")
    assert sorted(tuple(r) for r in first.only_left.collect()) == [("k", "1"), ("m", "3")]


def test_cell_diff_and_summary(spark):
    left = spark.createDataFrame([("a", " x ", 1.0), ("b", "y", 2.0)], "key string, s string, q double")
    right = spark.createDataFrame([("a", "X", 1.0), ("b", "y", 3.0)], "key string, s string, q double")
    res = diff.diff_by_keys(left, right, ["key"])
    cells = sorted(tuple(r) for r in res.cells.collect())
    assert cells == [("a", "s", "x", "X", 1), ("b", "q", "2.0", "3.0", 1)]
    dup_l = spark.createDataFrame([("k", "1"), ("k", "1")], "key string, v string")
    dup_r = spark.createDataFrame([("k", "2"), ("k", "2")], "key string, v string")
    dup = diff.diff_by_keys(dup_l, dup_r, ["key"]).cells.collect()
    assert [tuple(r) for r in dup] == [("k", "v", "1", "2", 2)] * 2   # once per pair, multiplicity 2
    ci = diff.diff_by_keys(left, right, ["key"], case_insensitive=True)
    assert ci.cells.count() == 1
    s = diff.diff_summary(res).first()
    assert (s.same, s.only_in_left_rows, s.only_in_right_rows, s.column_diff_rows) == (False, 0, 0, 2)


def test_diff_identity_and_counts(spark):
    from tallyho.sources import fixtures
    left = fixtures.diff_left(spark, "/root/testdata/sf0.001")
    right = fixtures.diff_right(spark, "/root/testdata/sf0.001")
    same = diff.diff_by_keys(left, left, fixtures.DIFF_KEYS)
    assert same.only_left.count() == 0 and same.only_right.count() == 0 and same.cells.count() == 0
    res = diff.diff_by_keys(left, right, fixtures.DIFF_KEYS)
    assert left.count() == res.pairs.count() + res.only_left.count()
    assert right.count() == res.pairs.count() + res.only_right.count()
    nl, nr = diff.diff_rows(left, left)
    assert nl.count() == 0 and nr.count() == 0


def test_pick_keys():
    lk, rk = diff.pick_keys(["憑單單號", "LINE", "x"], ["憑單單號", "line", "廠商代號"])
    assert lk == ["憑單單號", "LINE"] and rk == ["憑單單號", "line"]


def test_occurrence_number_hot_key(spark):
    # one key holds a third of the rows, and many rows are exact copies
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97).alias("k"),
        (F.col("id") % 11).alias("o"))
    got = occurrence_number(df, ["k"], ["o"], group_rows=50)
    want = df.groupBy("k", "o").count()
    # within a key, positions are 1..n without gaps, and ordered by o
    check = got.groupBy("k").agg(F.count("*").alias("n"), F.min("occ").alias("lo"), F.max("occ").alias("hi"),
                                 F.countDistinct("occ").alias("d"))
    assert check.where("lo != 1 OR hi != n OR d != n").count() == 0
    w = Window.partitionBy("k").orderBy("occ")
    bad = got.withColumn("prev", F.lag("o").over(w)).where(F.col("prev") > F.col("o")).count()
    assert bad == 0 and got.count() == 3000 and want.count() > 0


def test_fill_down_blocks(spark):
    rows = [("s", i, (f"v{i}" if i % 7 == 0 else None)) for i in range(1, 60)] + [("t", 5, None), ("t", 6, "z")]
    df = spark.createDataFrame(rows, "g string, pos long, v string")
    got = fill_down(df, ["g"], "pos", "v", out_col="f", block_rows=4)
    w = Window.partitionBy("g").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("f", F.last("v", ignorenulls=True).over(w))
    assert sorted(map(tuple, got.select("g", "pos", "f").collect())) == sorted(map(tuple, want.select("g", "pos", "f").collect()))


def test_occurrence_number_without_exchange_reuse(spark):
    """The passes agree without a shared exchange: a row's bucket depends on the row alone."""
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(0, 2000).select((F.col("id") % 3).alias("k"), (F.col("id") % 17).alias("o"))
        got = occurrence_number(df, ["k"], ["o"], group_rows=40)
        check = got.groupBy("k").agg(F.count("*").alias("n"), F.max("occ").alias("hi"),
                                     F.countDistinct("occ").alias("d"))
        assert check.where("hi != n OR d != n").count() == 0
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def _numbers_are_right(df, got, keys, order):
    """The same rows, numbered as a plain window numbers them, ties aside."""
    w = Window.partitionBy(*keys or [F.lit(0)]).orderBy(*order)
    got, want = got.collect(), df.withColumn("occ", F.row_number().over(w)).collect()
    view = lambda rows: sorted(([r[c] for c in (*keys, *order)] + [r["occ"]] for r in rows), key=repr)
    assert view(got) == view(want)
    rest = lambda rows: sorted((tuple(r[c] for c in df.columns) for r in rows), key=repr)
    assert rest(got) == rest(want)


def test_hot_key_is_spread(spark):
    """A key of 90 % of the rows, of which a third are copies: no task holds more than its share."""
    n = 60_000
    df = spark.range(0, n).select(
        F.when(F.col("id") % 10 > 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("o"))
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            got = occurrence_number(df, ["k"], ["o"], group_rows=2000)
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "InPandas" not in plan and "monotonically" not in plan
            _numbers_are_right(df, got, ["k"], ["o"])
        finally:
            spark.conf.set("spark.sql.exchange.reuse", "true")
    counts = got.where("k = -1").agg(F.count("*").alias("c"), F.max("occ").alias("m"), F.countDistinct("occ").alias("d")).first()
    assert counts.c == counts.m == counts.d == n * 9 // 10


def test_numbering_odd_values(spark):
    """Null keys are one key, nulls come first in the order, rows with maps and repeated rows are kept."""
    rows = [(None if i % 4 == 0 else "a", None if i % 5 == 0 else i % 7, {"x": i % 3}) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, o int, m map<string,int>")
    got = occurrence_number(df, ["k"], ["o"], group_rows=30)
    assert got.columns == ["k", "o", "m", "occ"]
    seen = {}
    for r in got.collect():
        seen.setdefault(r.k, []).append((r.occ, -1 if r.o is None else r.o))
    assert set(seen) == {None, "a"}
    for found in seen.values():
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(found) + 1)) and [f[1] for f in found] == sorted(f[1] for f in found)
    assert occurrence_number(df.limit(0), ["k"], ["o"]).count() == 0


def test_global_index(spark):
    from tallyho.operators.skew import global_index
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("v"), F.col("id").cast("string").alias("s"))
    got = global_index(df, ["v"], group_rows=200)
    assert got.where("pos <> v + 1").count() == 0 and got.count() == 5000
    # equal rows: every position once
    same = global_index(spark.range(0, 3000).select(F.lit(1).alias("v")), ["v"], group_rows=100)
    assert sorted(r.pos for r in same.collect()) == list(range(1, 3001))


def test_key_counts_meet_rows_by_blocks(spark, monkeypatch):
    """Multiplicity and first surplus rows of a hot key that spans several blocks."""
    monkeypatch.setattr(diff, "KEY_BLOCK", 8)
    left = spark.createDataFrame([("k", i, "l") for i in range(50)], "key string, o int, v string")
    right = spark.createDataFrame([("k", i, "r" if i % 2 else "l") for i in range(30)], "key string, o int, v string")
    cells = diff.diff_by_keys(left, right, ["key"], order=["o"]).cells.collect()
    assert len(cells) == 15 and {r.multiplicity for r in cells} == {30}
    first = diff.diff_by_keys(left, right, ["key"], order=["o"], surplus="first")
    assert sorted(int(r.o) for r in first.only_left.collect()) == list(range(20)) and first.only_right.count() == 0


def test_rows_diff_by_digests(spark):
    """Copies count by presence; with few buckets every row is compared, with many only those that differ."""
    left = spark.createDataFrame([(i % 40, "x") for i in range(200)] + [(100, "y")] * 3 + [(7, "n")] * 2, "a int, b string")
    right = spark.createDataFrame([(i % 40, "x") for i in range(160)] + [(200, "z")], "a int, c string")
    for buckets in (1, 7, 1 << 20):
        same_l, same_r = diff.diff_rows(left, left.repartition(3), buckets=buckets)
        assert same_l.count() == 0 and same_r.count() == 0
        ol, or_ = diff.diff_rows(left, right.withColumnRenamed("c", "b"), buckets=buckets)
        assert sorted(tuple(r) for r in ol.collect()) == [("100", "y")] * 3 + [("7", "n")] * 2
        assert [tuple(r) for r in or_.collect()] == [("200", "z")]
    ol, or_ = diff.diff_rows(left, right)
    assert ol.columns == or_.columns == ["a", "b", "c"] and ol.count() == 205 and or_.count() == 161


def test_negative_zero_is_one_key(spark):
    df = spark.createDataFrame([(0.0, 1), (-0.0, 2), (0.0, 3)], "k double, o int")
    got = sorted(r.occ for r in occurrence_number(df, ["k"], ["o"], group_rows=2).collect())
    assert got == [1, 2, 3]


def test_occurrence_number_unique_blocks(spark):
    from tallyho.operators.skew import occurrence_number_unique
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7 + 11).alias("o"))
    got = occurrence_number_unique(df, ["k"], "o", block_width=64)
    want = df.withColumn("occ2", F.row_number().over(Window.partitionBy("k").orderBy("o")))
    assert got.join(want, ["k", "o"]).where("occ != occ2").count() == 0 and got.count() == 5000


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_diff_shuffles_a_row_once(spark, monkeypatch):
    """Both directions come from one count of both sides; typed values, nulls and many copies are told apart as texts are."""
    monkeypatch.setattr(diff, "FEW", 4)
    schema = "a int, b int, t timestamp, d decimal(9,2), f boolean, q double, s string"
    shape = lambda a, b, hour, s="x", q=1.0: (a, b, datetime.datetime(2024, 1, 2, hour), Decimal("1.50"), True, q, s)
    left = [shape(None, 5, 1)] * 9 + [shape(1, 1, 1)] * 3 + [shape(2, 2, 3, " x ")] + [shape(3, 3, 3, "", -0.0)] + [(None,) * 7]
    right = [shape(5, None, 1)] * 2 + [shape(1, 1, 8)] + [shape(2, 2, 3)] + [shape(3, 3, 3, None, 0.0)] + [(None,) * 7]
    day = ("2024-01-02", "1.50", "true")
    for buckets in (1, 1 << 20):
        ol, or_ = diff.diff_rows(spark.createDataFrame(left, schema).select(*"abtdfqs"),
                                 spark.createDataFrame(right, schema).select(*"abtdfqs"), buckets=buckets)
        assert ol.columns == or_.columns == sorted("abtdfqs") and {t for _, t in ol.dtypes + or_.dtypes} == {"string"}
        at = lambda df: sorted(tuple(r[c] for c in "abtdfqs") for r in df.collect())
        assert at(ol) == [("", "5", *day, "1.0", "x")] * 9 + [("3", "3", *day, "-0.0", "")]
        assert at(or_) == [("3", "3", *day, "0.0", "")] + [("5", "", *day, "1.0", "x")] * 2
        assert "Join" not in _optimized(ol) + _optimized(or_)


def test_cells_pair_rows_once(spark):
    """Multiplicity comes with the numbering: the sides are joined once; typed values compare as their texts do."""
    schema = "k int, o int, n bigint, t timestamp, d date, f boolean, s string"
    noon, day = datetime.datetime(2024, 5, 6, 12), datetime.date(2024, 5, 6)
    left = [(1, 1, None, noon, day, True, " a"), (1, 2, 7, noon, None, True, "b"), (1, 3, 7, None, day, None, None), (None, 1, 4, noon, day, True, "c")]
    right = [(1, 1, 3, noon.replace(hour=1), day, True, "a "), (1, 2, 7, noon.replace(day=7), day, False, "b"), (None, 1, 5, noon, day, True, "c"), (9, 1, 1, noon, day, True, "")]
    res = diff.diff_by_keys(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["k"], order=["o"])
    assert sorted(tuple(r) for r in res.cells.collect()) == [
        ("", "n", "4", "5", 1), ("1", "d", "", "2024-05-06", 2), ("1", "f", "true", "false", 2), ("1", "n", "", "3", 2),
        ("1", "t", "2024-05-06", "2024-05-07", 2)]
    assert [r.o for r in res.only_left.collect()] == ["3"] and [r.k for r in res.only_right.collect()] == ["9"]
    assert res.cells.dtypes[-1] == ("multiplicity", "bigint")
    assert _optimized(res.cells).count("Join") == 1


def test_numbering_shuffles_plain_rows(spark):
    """The order's columns and hashes are computed behind the shuffle; sizes of keys come with the numbers."""
    df = spark.range(0, 900).select(F.when(F.col("id") % 3 > 0, F.lit(None)).otherwise(F.col("id") % 7).alias("k"),
                                    F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("o"))
    _, shuffled = _optimized(occurrence_number(df, ["k"], ["o"])).split("RepartitionByExpression")
    assert "xxhash64" not in shuffled and "struct" not in shuffled
    want = {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    for group_rows in (30, 1 << 14):
        got = occurrence_number(df, ["k"], ["o"], group_rows=group_rows, size_col="n")
        assert got.columns == ["k", "o", "occ", "n"]
        _numbers_are_right(df, got, ["k"], ["o"])
        assert {(r.k, r.n) for r in got.collect()} == set(want.items())
