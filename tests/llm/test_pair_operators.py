"""MinHash and embedding near-duplicates, connected components."""
import math
import random

import numpy as np
from helpers import ODD, components, documents, near_components, near_copies

from tallyho.llm import embeddings, minhash
from tallyho.llm.common import prepare
from tallyho.llm.components import components as spark_components


def test_components_equal_brute_force(spark):
    prepare(spark)
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(40)] + [(rng.randint(100, 400), rng.randint(100, 400)) for _ in range(150)]
    pairs += [(1000, 1000 + i) for i in range(1, 60)]
    table = spark.createDataFrame([*pairs, (7, 7), (None, 3), (3, None), pairs[0]], "a long, b long")
    got = {r["id"]: r["component"] for r in spark_components(table).collect()}
    nodes = {x for a, b in pairs for x in (a, b) if a != b}
    assert got == components([(a, b) for a, b in pairs if a != b], nodes)
    assert spark_components(table.limit(0)).count() == 0


def check(spark, texts, p=minhash.Params()):
    want = near_components(texts)
    rows = minhash.near_duplicates(documents(spark, list(texts.items()), extra=True), p).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_near_duplicates_equal_brute_force(spark):
    prepare(spark)
    check(spark, near_copies())


def test_contested_blocks_equal_brute_force(spark):
    """Few partners and tiny blocks: what the rounds leave is found by the blocks."""
    prepare(spark)
    check(spark, near_copies(seed=8, groups=3, copies=40), minhash.Params(crowd=10_000, block=300))


def test_threshold_is_exact(spark):
    prepare(spark)
    # 15 of 20 shingles in common is a link at 0.75, 14 of 19 is none
    base = [f"b{i}" for i in range(24)]
    at = {1: " ".join(base[:23]), 2: " ".join(base[:19])}
    check(spark, at)
    check(spark, {1: " ".join(base[:19] + ["x"] * 5), 2: " ".join(base[:18])})


def test_overlaps_equal_brute_force():
    import pyarrow as pa
    rng = random.Random(1)
    sets = [sorted(rng.sample(range(60), rng.randint(0, 40))) for _ in range(30)]
    got = minhash._overlaps(pa.array(sets[:12], pa.list_(pa.int64())), pa.array(sets[12:], pa.list_(pa.int64())))
    assert got.tolist() == [[len(set(a) & set(b)) for b in sets[12:]] for a in sets[:12]]


def one_block(sets, comps=None):
    import pyarrow as pa
    n = len(sets)
    return pa.table({"block_x": [1] * n, "block_y": [1] * n, "own": [True] * n, "id": range(n), "comp": comps or list(range(n)),
                     "n": [len(s) for s in sets], "keys": pa.array(sets, pa.list_(pa.int64()))})


def test_block_of_many_short_classes_stays_small():
    """8,000 classes of 12 shingles are half of what a block may hold; a whole matrix of them takes 512 MB."""
    import tracemalloc
    sets = [[0, *range(1 + 11 * i, 12 + 11 * i)] for i in range(8000)]
    sets[7999] = sets[3]
    table = one_block(sets)
    tracemalloc.start()
    a, b = minhash._block_links(table, minhash.Params())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {*a.tolist(), *b.tolist()} == {3, 7999} and len(a) == 1
    assert peak < 400 << 20


def test_strips_connect_what_all_pairs_connect():
    rng = random.Random(6)
    bases = [rng.sample(range(400), 12) for _ in range(6)]
    sets = [sorted({*rng.sample(rng.choice(bases), 11), rng.randrange(400)}) for _ in range(70)]
    comps = [rng.choice([i, i - i % 3]) for i in range(70)]
    pairs = [(i, j) for i in range(70) for j in range(i) if 100 * len({*sets[i]} & {*sets[j]}) >= 75 * len({*sets[i]} | {*sets[j]})]
    own = list(enumerate(comps))
    want = components(pairs + own, range(70))
    for cells in (1, 300, 1 << 22):
        a, b = minhash._block_links(one_block(sets, comps), minhash.Params(), cells)
        assert components([*zip(a.tolist(), b.tolist()), *own], range(70)) == want
        assert len(a) < len(set(comps))


def test_contested_ids_with_several_texts(spark):
    """Each text of a repeated id is measured by its own set, in whichever rows it comes."""
    prepare(spark)
    def text(*parts):  # words of their own between parts: n words are n - 4 shingles
        return " ".join(f"{name}{i}" for name, a, b in parts for i in range(a, b))
    # 1 holds sets of 96 and 56 shingles; 2 has 56 of 66 in common with the first; 3 is near the first, 5 near 4
    long, short = text(("a", 0, 100)), text(("c", 0, 60))
    rows = [(1, long), (1, long), (1, short), (2, text(("a", 0, 60), ("b", 0, 10))), (3, text(("a", 0, 96), ("d", 0, 4))),
            (4, text(("e", 0, 100))), (4, text(("e", 0, 100))), (5, text(("e", 0, 90)))]
    sizes = {1: (96, 56), 2: (66,), 3: (96,), 4: (96,), 5: (86,)}
    members = spark.createDataFrame([(i, 9, 5, n, 0, 0, i) for i in sizes for n in sizes[i]],
                                    "id long, key long, size long, n long, bits_a long, bits_b long, comp long")
    got = minhash._contested_links(members, spark.createDataFrame(rows, "doc_id long, text string"), minhash.Params())
    assert {(r["a"], r["b"]) for r in got.collect()} == {(1, 3), (4, 5)}


def test_signature_estimates_similarity():
    p, rng = minhash.Params(), np.random.default_rng(0)
    common = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = np.r_[common, rng.integers(0, 1 << 63, 500, dtype=np.uint64)], np.r_[common, rng.integers(0, 1 << 63, 500, dtype=np.uint64)]
    same = (minhash.signature(a, p) == minhash.signature(b, p)).mean()
    assert abs(same - 0.75) < 0.15


def test_near_duplicates_odd_rows(spark):
    prepare(spark)
    docs = documents(spark, ODD, extra=True)
    rows = minhash.near_duplicates(docs).collect()
    assert len(rows) == len(ODD)
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_shingles"] == by[2]["n_shingles"] == by[3]["n_shingles"] == 0
    assert by[2]["kept"] and by[3]["kept"] and by[4]["n_shingles"] == 1
    assert by[None]["component_id"] is None and by[None]["kept"]
    kept = minhash.dedup(docs)
    assert kept.columns == docs.columns and kept.count() == len(ODD) - 1  # id 6 is there twice with the same text
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    assert minhash.dedup(docs.limit(0)).count() == 0


def test_dedup_takes_rows_not_ids(spark):
    """Rows of one id are judged by their texts; of equal rows and of copies without id one stays."""
    prepare(spark)
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = a + " end"
    rows = [(0, a, "x"), (1, a, "y"), (1, b, "y"), (2, b + " end", "y"), (3, c, "p"), (3, c, "q"), (4, near, "x"),
            (None, "some other words that only rows without id have", "x"), (None, "some other words that only rows without id have", "z"),
            (None, a, "x"), (5, None, "x"), (5, None, "x"), (None, " ", "x"), (6, c + " one", "x"), (6, c + " two", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").selectExpr("*", "1 as odd", "2 as name", "3 as _id")
    kept = minhash.dedup(docs)
    assert kept.columns == docs.columns
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"]) for r in kept.select("doc_id", "text").collect() if (r["text"] or "").strip())
    texts = [t for _, t in got]
    assert (0, a) in got and near not in texts and texts.count(a) == 1
    assert [i for i, t in got if t == b or t == b + " end"] == [2]  # a named row goes before rows of repeated ids
    assert sum(t.startswith("c0") for t in texts) == 1
    assert texts.count("some other words that only rows without id have") == 1 and len(got) == 4
    assert kept.filter("trim(coalesce(text, '')) = ''").count() == 3


def test_repeated_ids_are_one_node(spark):
    prepare(spark)
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(0, a), (1, a), (1, b), (2, b + " end"), (3, "nothing like the others at all")]
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, 0, True), (1, 0, False), (1, 0, False), (2, 0, False), (3, 3, True)]
    rng = np.random.default_rng(1)
    va, vb = rng.standard_normal(16).tolist(), rng.standard_normal(16).tolist()
    vectors = [(0, va, 0), (1, va, 0), (1, vb, 0), (2, [x * 2 for x in vb], 0), (3, rng.standard_normal(8).tolist(), 0), (1, None, 0)]
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(
        spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int")).collect())
    assert got == [(0, 1, 0), (1, 0, 0), (1, 1, 0), (1, 1, 0), (2, 1, 0), (3, 0, 3)]


def test_embeddings_of_several_lengths(spark):
    """Vectors of different lengths in one batch, each with near ones of its own length."""
    prepare(spark)
    rng, rows = np.random.default_rng(3), []
    for n in (16, 8, 5, 7):
        for _ in range(6):
            centre = rng.standard_normal(n)
            rows += [(len(rows) + i, (centre + rng.standard_normal(n) * .03).tolist(), 0) for i in range(5)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == brute_force(rows)


def brute_force(rows):
    def usable(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    unit = {}
    for i, v, label in rows:
        if label is not None and usable(v):
            x = np.array(v, np.float64)
            unit[i] = (label, x / np.sqrt((x * x).sum()))
    links = [(a, b) for a in unit for b in unit if a < b and unit[a][0] == unit[b][0] and len(unit[a][1]) == len(unit[b][1])
             and unit[a][1] @ unit[b][1] >= 0.98]
    least = components(links, [r[0] for r in rows])
    return {i: (sum(i in x for x in links), least[i]) for i, _, _ in rows}


def vectors(seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(25):
        centre = rng.standard_normal(16)
        for _ in range(rng.integers(1, 18)):
            v = centre + rng.standard_normal(16) * rng.choice([0, .02, .1, .15, .2])
            rows.append((len(rows), [float(np.float32(x)) for x in v * rng.choice([1, 1, 3])], int(rng.integers(0, 2))))
    n = len(rows)
    odd = [None, [], [0.0] * 16, [None] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, rows[0][1][:8], rows[0][1]]
    return rows + [(n + i, v, 0) for i, v in enumerate(odd)] + [(n + 20, rows[0][1], None)]


def test_embeddings_equal_brute_force(spark):
    prepare(spark)
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as id", "2 as n_links")
    want = brute_force(rows)
    for p in (embeddings.Params(), embeddings.Params(block=3)):
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(table, p).collect()}
        assert got == want
    assert embeddings.near_duplicates(table.limit(0)).count() == 0


def test_embeddings_repeated_rows(spark):
    prepare(spark)
    rows = [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (None, [1.0, 2.0], 0), (3, [-2.0, 1.0], 0)]
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in embeddings.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect())
    assert got == [(0, 0, 0, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
