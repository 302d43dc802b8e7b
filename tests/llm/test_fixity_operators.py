"""Whitening, personal data and the Merkle manifest against brute-force versions."""
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import ODD, documents
from oracle_check import compare, duck
from tallyho.llm import manifest, pii, queries, whitening
from tallyho.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op12_pii", "op13_manifest"])
def test_query_matches_sql(spark, name):
    assert compare(spark, duck(SF), name, queries.QUERIES[name], ORACLE[name], SF)


# ---- personal data -------------------------------------------------------------------
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
         "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0


def passes(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.split(".")),
            "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def base(text):
    found = sorted((m.start(), i, m.end(), k) for i, (k, p) in enumerate(PLAIN.items())
                   for m in re.finditer(p, text or "") if passes(k, m.group()))
    return [f"{k}:{s}:{e}" for s, _, e, k in found]


CASES = [(1, "a@b.c_d@e.f x@y. a..b@c.d.e. 1.2.3.4.5.6.7.8 999.1.1.1 0001.002.3.0255 1.2.3.000000000000000000256"),
         (2, "card 4111 1111 1111 1111, 4111-1111-1111-1112 +1 (603) 555-8791 +12 34"), (3, None), (4, ""),
         (5, "\U0001F600é a@b.cc \U0001F600 1.2.3.4"),
         (6, "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432 not GB83WEST12345698765432 SSN 123-45-6789 call (603) 555-1234, "
             "thanks for the whole of it and all the rest of the day, order 603-555-9999 plain 603 555 9999 at 000-45-6789"),
         (7, "x@y.zz 10.0.0.1 "*3000), (8, "a" * 400000 + "@" + "b" * 100 + ".c" + ".d" * 100000), (9, "+1" + "(" * 100000 + " 5"),
         (10, "1 2-3 " * 30000), (None, "a@b.cc"), (2, "a@b.cc")]


def test_spans_against_plain_patterns(spark):
    docs = documents(spark, CASES, extra=True)
    rows = docs.collect()
    got = pii.digests(docs).collect()
    key = lambda r: (str(r[0]), r[1])
    assert sorted(map(key, ((r.doc_id, r.base_sha256) for r in got))) == sorted(
        map(key, ((r.doc_id, hashlib.sha256(",".join(base(r.text)).encode()).hexdigest()) for r in rows)))
    by_id = {r.doc_id: r for r in got}
    assert by_id[6].spans == "iban:5:32,iban:37:59,ssn:91:102,tel:108:122" and by_id[6].n_card == 0
    assert (by_id[7].n_email, by_id[7].n_ip) == (3000, 3000) and by_id[3].spans == by_id[4].spans == ""
    assert pii.digests(docs.limit(0)).count() == 0


def test_findings_and_redaction(spark):
    docs = documents(spark, [c for c in CASES if c[0] in (2, 3, 6)], extra=True)
    found = pii.findings(docs).collect()
    assert {(r.kind, r.value, r.score) for r in found if r.doc_id == 6} == {
        ("iban", "DE89 3704 0044 0532 0130 00", .9), ("iban", "GB82WEST12345698765432", .7), ("ssn", "123-45-6789", .7),
        ("tel", "(603) 555-1234", .7)}
    text = {(r.doc_id, r.value): r for r in found}
    assert text[2, "4111 1111 1111 1111"].score > .7 and len(found) == 7
    out = pii.redacted(docs)
    assert out.columns == docs.columns
    got = {r.text for r in out.collect()}
    assert None in got and "a@b.cc" not in got and "card [CARD], 4111-1111-1111-1112 [PHONE] +12 34" in got
    assert any(t and t.startswith("IBAN [IBAN] and [IBAN] not GB83WEST12345698765432 SSN [SSN] call [TEL], thanks") for t in got)


def test_running_sums_in_blocks(spark):
    for n in (0, 1, 255, 256, 257, 2000):
        rows = spark.range(1).select(F.array(*[F.lit(i).cast("long") for i in range(n)]).cast("array<bigint>").alias("a"))
        assert rows.select(pii._running(F.col("a"))).first()[0] == np.arange(n).cumsum().tolist()


def test_pii_is_native(spark):
    plan = pii.digests(documents(spark, ODD))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


# ---- Merkle manifest -----------------------------------------------------------------
def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row.doc_id, row.source, row.lang, row.n_chars, text)])


def climb(nodes):
    """Root, and per node the runs and slots on its way up."""
    ways, places, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        runs = [level[i:i + 16] for i in range(0, len(level), 16)]
        for w, place in zip(ways, places):
            w.append((runs[place // 16], place % 16))
        places, level = [p // 16 for p in places], [H(*r) for r in runs]
    return level[0], ways


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r.source, []).append((-1 if r.doc_id is None else r.doc_id, leaf_of(r, r.text), r))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([leaf for _, leaf, _ in sorted(by_source[s], key=lambda x: x[:2])]) for s in names}
    root, tops = climb([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        for (_, leaf, r), way in zip(sorted(by_source[s], key=lambda x: x[:2]), trees[s][1]):
            hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
            node, siblings = leaf_of(r, lowered(r.text)) if hit else leaf, []
            for run, slot in way + top:
                siblings += run[:slot] + run[slot + 1:]
                node = H(*run[:slot], node, *run[slot + 1:])
            out.append((r.doc_id, leaf, trees[s][0], root, H(*siblings), node, node == root))
    return sorted(out, key=repr)


def test_manifest_against_brute_force(spark):
    """Sources of 1 to 5,000 rows: several superblocks, a last one of few leaves; null, repeated and odd rows."""
    rows = [(i, f"Text {i}", "en", "big") for i in range(4096 + 17)] + [(10_000 + i, f"T{i}", None, f"s{i % 40}") for i in range(700)]
    rows += [(i, "Ä é B", "en", "") for i in range(20_000, 20_016)] + [(30_000, "alone", "de", "x:1"), (31_000, "n", "en", None)] + ODD
    docs = documents(spark, rows, extra=True)
    got = manifest.manifest(docs, queries.tampered(docs))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs.collect())
    # small superblocks: every level above them in Spark
    few = docs.filter("doc_id < 900 or doc_id >= 10000 or doc_id is null")
    got = manifest.manifest(few, queries.tampered(few), manifest.Params(levels=1))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(few.collect())


def test_manifest_of_few_rows(spark):
    one = documents(spark, [(5, None, None, None)])
    row = manifest.manifest(one).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified and row.proof_sha256 == H("")
    assert manifest.manifest(one.limit(0)).count() == 0


# ---- whitening -----------------------------------------------------------------------
VEC = "vec_id long, embedding array<double>, label string, component string, n string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "clash", "clash") for i, v in rows], VEC)


def held(out, rows, most=32):
    """``out`` against exact integers and numpy's eigenvectors; rows are (id, vector) of the fit list."""
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in rows], object)
    n, total = len(x), x.sum(axis=0)
    centred = x * n - total
    scatter = (centred.T @ centred).astype(object)
    values, axes = np.linalg.eigh(scatter.astype(np.float64) / float(n) ** 3)
    values, axes = values[::-1], axes[:, ::-1]
    want = sorted((i, int((c * c).sum())) for (i, _), c in zip(rows, centred))
    for k in sorted({r.component for r in out}):
        mine = sorted((r.vec_id, r.deviation, r.whitened) for r in out if r.component == k)
        assert [m[:2] for m in mine] == want
        share = values[k - 1] / values.sum()
        assert {abs(r.explained / share - 1) < 1e-6 for r in out if r.component == k} == {True}
    assert {r.n for r in out} == {n} and all(r.identity_error < 1e-8 for r in out)
    return values, axes, centred / n


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(2)
    data = rng.standard_normal((300, 12)) @ np.diag(np.linspace(3, .2, 12)) @ rng.standard_normal((12, 12))
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(7, data[0].tolist())]
    odd = [(900, None), (901, []), (902, [None] * 12), (903, [float("nan")] + [0.0] * 11), (904, [float("inf")] * 12),
           (905, [1e300] * 12), (906, [1.0] * 5)]
    out = whitening.whiten(vectors(spark, rows + odd).repartition(5), whitening.Params(components=9)).collect()
    assert len(out) == 301 * 9
    values, axes, centred = held(out, rows)
    for k in range(9):
        mine = {}
        for r in out:
            if r.component == k + 1:
                mine.setdefault(r.vec_id, []).append(r.whitened)
        want = centred.astype(float) @ axes[:, k] / np.sqrt(values[k])
        once = [at for at, (i, _) in enumerate(rows) if i != 7]  # 7 is repeated
        got = np.array([mine[rows[at][0]][0] for at in once])
        assert min(np.abs(got - want[once]).max(), np.abs(got + want[once]).max()) < 1e-9


def test_whitening_of_repeated_and_zero_eigenvalues(spark):
    # two equal eigenvalues by construction, one constant entry, one that doubles another
    rows = [(4 * i + j, [float(a), float(b), 5.0, 3.0 * i, 6.0 * i]) for i in range(4) for j, (a, b) in enumerate([(1, 1), (1, -1), (-1, 1), (-1, -1)])]
    out = whitening.whiten(vectors(spark, rows)).collect()
    assert {r.component for r in out} == {1, 2, 3}
    held(out, rows)
    assert whitening.whiten(vectors(spark, rows[:1])).count() == 0
    assert whitening.whiten(vectors(spark, rows).limit(0)).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [2.0, 3.0])] * 3)).count() == 0


def test_whitening_of_large_and_nearly_equal_entries(spark):
    """Entries whose products exceed a long, and eigenvalues that differ in the twelfth digit only."""
    big = [(i, [float((-1) ** i * 2**40 + i), float(i * i), 1.0 * (i % 3)]) for i in range(30)]
    out = whitening.whiten(vectors(spark, big)).collect()
    assert {r.component for r in out} == {1, 2, 3} and all(r.identity_error < 1e-6 for r in out)
    x = np.array([[int(64 * c) for c in v] for _, v in big], object)
    dev = ((x * 30 - x.sum(axis=0)) ** 2).sum(axis=1)
    assert {r.vec_id: r.deviation for r in out} == {i: int(d) if d < 1 << 63 else None for (i, _), d in zip(big, dev)}
    close = np.diag([10**14, 10**14 + 1, 10**14 + 2, 3]).astype(object)
    roots, axes = whitening.components(spark, close, whitening.Params())
    assert [int(round(r)) for r in roots] == [10**14 + 2, 10**14 + 1, 10**14, 3]
    assert np.allclose(np.abs(axes), np.eye(4)[[2, 1, 0, 3]], atol=1e-12)


def test_polynomial_against_exact_determinants(spark):
    rng = np.random.default_rng(4)
    a = rng.integers(-9, 9, (20, 6)).astype(object)
    matrix = a.T @ a
    poly = whitening.polynomial(spark, matrix)
    # Faddeev-LeVerrier, exact
    m, c, want = np.zeros((6, 6), object), 1, [1]
    for k in range(1, 7):
        m = matrix @ m + c * np.eye(6, dtype=int).astype(object)
        c = -int(np.trace(matrix @ m)) // k
        want.append(c)
    assert poly == want[::-1]
    roots = sorted(np.linalg.eigvalsh(matrix.astype(float)))
    for at in (0, 5, 40, 200):
        assert whitening.roots_above(poly, at, 0) == sum(r > at for r in roots)
