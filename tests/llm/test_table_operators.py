"""Mixing, chat formatting, WARC fixity, URL filter, the SQL cross-check and the pipeline."""
import hashlib

import pytest
from helpers import ODD, WORD, documents, near_components
from oracle_check import compare, duck
from pyspark.sql import functions as F
from test_text_operators import measured_by_hand

import corpus_pipeline
from tallyho.llm import chat, lang, minhash, mixing, quality_rules, url_filter, warc
from tallyho.llm.common import prepare, read
from tallyho.llm.oracle import ORACLE
from tallyho.llm.queries import QUERIES, vocabulary

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert compare(spark, duck(SMALL), name, QUERIES[name], ORACLE[name], SMALL)


def targets_by_hand(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Share by weight, cut what is above its limit, share the excess again, until nothing is above."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    full, total = set(), share * sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(most * sizes[s] for s in full)
        got = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = {s for s in rest if got[s] > most * sizes[s]}
        if not over:
            return {**{s: most * sizes[s] for s in full}, **got}
        full |= over


def test_targets_equal_sharing_by_rounds(spark):
    prepare(spark)
    for sizes in ({"a": 100, "b": 900, "c": 50, None: 3, "Z": 0, "é": 70}, {"a": 1}, {"a": 5, "b": 5, "c": 5000, "d": 1}):
        rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "_mix_source string, _mix_size long")
        got = {r["_mix_source"]: r["target"] for r in mixing.targets(rows).collect()}
        want = targets_by_hand(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_mix_of_rows_without_ids_comes_near_its_target(spark):
    """1,600 rows without id, half of them equal, and 1,500 of one id: each source near its target."""
    prepare(spark)
    rows = [(None, "w " * 50 if i % 2 else f"w{i} " * 50, "en", "a") for i in range(1600)] + [(7, f"x{i % 40} " * 40, "en", "b") for i in range(1500)]
    docs = documents(spark, rows + [(100 + i, "z " * 50, "en", "c") for i in range(1000)], extra=True)
    got = mixing.mix_sizes(docs).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    assert len(by) == 3 and all(abs(sum(t) - target) < 0.06 * target for (_, target), t in by.items())
    again = documents(spark, rows[::-1] + [(100 + i, "z " * 50, "en", "c") for i in range(1000)], extra=True).repartition(5)
    assert sorted(map(tuple, mixing.mix_sizes(again).collect()), key=repr) == sorted(map(tuple, got), key=repr)
    assert mixing.mix(docs).count() == sum(r["taken"] // r["size"] for r in got)


def test_stages_take_clashing_columns(spark):
    """Columns named like helper columns come back as they were."""
    prepare(spark)
    texts = [(i, " ".join(f"word{j % 61} and{j}" for j in range(i, i + 60)) + ".", "en", "s") for i in range(40)]
    names = ("_lang_text", "_lang_pred", "_q_t", "_q_n_words", "_mix_size", "_mix_coin", "_mix_nth", "_url", "c0", "c1", "row", "name", "_id")
    docs = documents(spark, texts).selectExpr("*", *[f"'K{i}' as `{n}`" for i, n in enumerate(names)])
    for stage in (quality_rules.keep_passing, lang.keep_identified, mixing.mix, minhash.dedup):
        out = stage(docs)
        assert out.columns == docs.columns
        assert {tuple(r) for r in out.select(*[f"`{n}`" for n in names]).collect()} == {tuple(f"K{i}" for i in range(len(names)))}
    pages = spark.createDataFrame([(1, "http://a.org/x", "U"), (2, None, "U")], "page_id long, url string, _url string")
    out = url_filter.keep_allowed(pages)
    assert out.columns == pages.columns and {r["_url"] for r in out.collect()} == {"U"}


def test_mix_takes_what_it_says(spark):
    prepare(spark)
    docs = documents(spark, ODD + [(100 + i, "w " * (i % 40), "en", "abc"[i % 3]) for i in range(600)], extra=True)
    rows = mixing.mix_sizes(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert sum(len(WORD.findall(r["text"] or "")) for r in mixed.collect()) == sum(r["taken"] for r in rows)
    assert sorted(map(tuple, mixing.mix_sizes(docs).collect()), key=repr) == sorted(map(tuple, rows), key=repr)
    by = {}
    for r in rows:
        by.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    assert all(abs(sum(t) - target) < 0.25 * target + 60 for (n, target), t in by.items() if n > 1000)
    assert mixing.mix_sizes(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


NASTY = ["", "</s>", "<|turn|>x<|text|>", "\\l \\b \\", "\\\\l<\\<", "[INST]\n", "a\nb", "<", "é漢\U0001f600</s>"]


def test_chat_round_trip(spark):
    prepare(spark)
    rows = [(c, t, ["user", "assistant", None, "</s>"][(c + t) % 4], NASTY[(c * 3 + t) % len(NASTY)])
            for c in range(9) for t in range(7)] + [(99, 0, "user", None), (None, 0, "assistant", "x"), (5, 3, "user", "tie")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as seq", "2 as msg")
    shown = chat.format_conversations(table)
    turns = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1], r[2] is not None, r[2], r[3] or "")):
        turns.setdefault(c, []).append((role or "", text or ""))
    for r in shown.withColumn("turns", chat.parse(F.col("formatted"))).collect():
        assert [tuple(x) for x in r["turns"]] == turns[r["conv_id"]]
        under = [r["formatted"][m["from"] - 1:m["from"] - 1 + m["chars"]] for m in r["mask"]]
        assert [u.replace("\\l", "<").replace("\\b", "\\") for u in under] == [x for role, x in turns[r["conv_id"]] if role == "assistant"]
    for r in chat.digests(shown).collect():
        said = "".join(f"{a}\n{b}\n" for a, b in turns[r["conv_id"]])
        assert r["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest() and r["n_turns"] == len(turns[r["conv_id"]])
    assert chat.digests(chat.format_conversations(table.limit(0))).count() == 0


def test_events_fold_to_final_messages(spark):
    log = [(1, 0, "m1", "delta", "user", "hel"), (1, 1, "m1", "delta", None, "lo"), (1, 2, "m2", "delta", "assistant", "bad"),
           (1, 3, "m2", "regenerate", None, None), (1, 4, "m2", "delta", None, "go"), (1, 5, "m2", "delta", None, "od"),
           (1, 6, "m1", "edit", None, "bye"), (1, 7, "m1", "delta", None, "!"), (2, 0, "m1", None, "user", None)]
    rows = chat.fold(spark.createDataFrame(log, "conv_id long, seq long, msg string, kind string, role string, text string"))
    assert sorted((r["conv_id"], r["first"], r["role"], r["text"]) for r in rows.collect()) == [
        (1, 0, "user", "bye!"), (1, 2, "assistant", "good"), (2, 0, "user", "")]


def test_chat_is_native_with_one_shuffle(spark):
    plan = chat.format_conversations(read(spark, SMALL, "conversations"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_records_hold_their_payload(spark):
    pages = read(prepare(spark), SMALL, "pages")
    for r in warc.records(pages).withColumn("payload", warc.payload(F.col("record"))).join(pages, "page_id").collect():
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        assert rest == r["html"].encode() + b"\r\n\r\n" and r["payload"] == r["html"]
        assert f"Content-Length: {len(r['html'].encode())}".encode() in head


def test_audit_finds_every_fault_and_nothing_else(spark):
    prepare(spark)
    rows = [(i, f"http://h/{i}", "x" * (i % 50)) for i in range(300)] + [(None, None, None), (7, "http://h/7", "again")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record", F.lit(1))
    p = warc.Params(fanout=4, archive=64)
    left = warc.index(warc.records(pages, p))
    assert warc.audit(left, left, p).count() == 0
    bad = warc.index(warc.records(pages.withColumn("html", F.when(F.col("page_id").isin(70, 71, 200), "changed").otherwise(F.col("html"))), p))
    bad = bad.filter("not (archive = 0 and nth >= 60)")
    found = warc.located(warc.audit(left, bad, p), left, bad).collect()
    a, b = ({(r["archive"], r["nth"]): (r["from"], r["bytes"], r["hash"]) for r in x.collect()} for x in (left, bad))
    want = {k for k in a.keys() | b.keys() if a.get(k) != b.get(k)}
    assert {(r["archive"], r["nth"]) for r in found} == want
    kinds = {r["page_id"]: r["kind"] for r in found if r["archive"] != 0}
    assert kinds[70] == kinds[200] == "corrupt" and {r["kind"] for r in found if r["archive"] == 0} == {"missing"}
    # same length, same place: nothing after a record that changed in place differs
    assert warc.audit(left.limit(0), left.limit(0), p).count() == 0
    assert warc.audit(left, left.limit(0), p).count() == len(rows)


def test_audit_tells_shifted_records_from_lost_ones(spark):
    prepare(spark)
    p = warc.Params(fanout=4, archive=64)
    rows = [(i, f"http://h/{i:03}", "x" * (20 if i >= 128 else i % 50)) for i in range(256)]
    rows += [(None, "http://n/1", "n"), (None, "http://n/1", "n"), (None, "http://n/2", "m")]
    def replica(without, changed=()):
        kept = [(i, u, ("y" + h[1:] if i in changed else h)) for i, u, h in rows if i not in without]
        return warc.index(warc.records(spark.createDataFrame(kept, "page_id long, url string, html string"), p))
    # archive 0 loses 10 and corrupts 40 behind the gap; 1 gains 70; 2 loses 130 and gains 150, of equal sizes; 3 is as it was
    left, right = replica({70, 150}), replica({10, 130}, {40, 200})
    found = {r["page_id"]: r for r in warc.located(warc.audit(left, right, p), left, right).collect()}
    want = {10: "missing", 40: "corrupt", 70: "added", 130: "missing", 150: "added", 200: "corrupt"}
    want |= {i: "moved" for i in [*range(11, 64), *range(71, 128), *range(131, 150)] if i != 40}
    assert {i: r["kind"] for i, r in found.items()} == want
    assert (found[40]["archive"], found[40]["nth"]) == (0, 40) and (found[70]["archive"], found[70]["nth"]) == (1, 6)
    one = left.filter("not (archive = -1 and nth = 1)")  # of two equal records without an id one is lost
    gap = one.withColumn("nth", F.when(F.col("archive") == -1, F.least("nth", F.lit(1))).otherwise(F.col("nth"))).withColumn(
        "from", F.when((F.col("archive") == -1) & (F.col("nth") == 1), F.col("bytes")).otherwise(F.col("from")))
    kinds = [r["kind"] for r in warc.located(warc.audit(left, gap, p), left, gap).collect()]
    assert kinds.count("missing") == 1 and {*kinds} <= {"missing", "moved"}


def test_url_parts_and_rules(spark):
    prepare(spark)
    urls = {"http://A.Example.ORG/es/x?y#z": ("a.example.org", "/es/x", "example.org/es/", "block"),
            "https://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "allow"),
            "x://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"), "http://example.org": ("example.org", "", None, "allow"),
            "http://b.com/de/1": ("b.com", "/de/1", "com/de/", "block"), "http://b.com/fr/": ("b.com", "/fr/", "com/fr/", "allow"),
            "http://h?q://z/": ("h", "", None, "allow"), "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"),
            "http://org/": ("org", "/", "org/", "allow"), None: ("", "", None, "allow")}
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(0, next(iter(urls))), (None, "http://c.net/")],
                                  "page_id long, url string").selectExpr("*", "1 as host", "2 as rule", "3 as n")
    rows = url_filter.judge(pages).collect()
    assert len(rows) == len(urls) + 2
    for r in rows:
        if r["page_id"] is not None:
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == list(urls.values())[r["page_id"]]
    kept = url_filter.keep_allowed(pages)
    assert kept.columns == pages.columns and kept.count() == len(urls) + 2 - 3
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_rules_are_the_contracts(spark):
    prepare(spark)
    assert [(r.place, r.verdict) for r in url_filter.RULES] == [
        ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
    urls = ["http://example.org/en/1", "http://a.example.org/en/12/x", "http://example.org/en/2"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge(pages).collect()}
    assert got == {0: ("example.org/en/1", "block"), 1: ("example.org/en/1", "block"), 2: ("org/", "allow")}


def test_reputation_blocks_hosts_with_many_bad_pages(spark):
    prepare(spark)
    urls = [f"http://bad.com/de/{i}" for i in range(200)] + ["http://bad.com/en/1"] + [f"http://h{i}.com/fr/{j}" for i in range(30) for j in range(9)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages).collect()}
    assert got[200] == "block" and all(got[i] == "allow" for i in range(201, len(urls)))


def pipeline_by_hand(spark, sf_dir):
    """Documents after the first four stages, and ids after the last."""
    tokenizer = pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary())
    docs = [r.asDict() for r in read(spark, sf_dir, "documents").collect()]
    def passes(d):
        n, chars, symbols, dup, repeat, lines = measured_by_hand(d["text"])
        return not (n < 50 or 100 * repeat > 50 * n or 100 * symbols > 5 * chars or 100 * dup > 40 * lines or chars < 2 * n or chars > 30 * n)
    docs = [d for d in docs if passes(d)]
    model = lang.fit(documents(spark, [tuple(d.values()) for d in docs]).filter(~lang.held_out()))
    said, score = lang.identify([d["text"] for d in docs], model)
    docs = [d for d, s, x in zip(docs, said, score) if s != "und" and x >= 0.5]
    least = near_components({d["doc_id"]: d["text"] for d in docs})
    docs = [d for d in docs if least[d["doc_id"]] == d["doc_id"]]
    sizes = {}
    for d in docs:
        sizes[d["source"]] = sizes.get(d["source"], 0) + len(WORD.findall(d["text"]))
    target, out = targets_by_hand(sizes), []
    for d in docs:
        rate = target[d["source"]] / sizes[d["source"]]
        coin = int(hashlib.md5(f"mix-1:{d['doc_id']}".encode()).hexdigest()[:8], 16) / 2 ** 32
        out += [d["doc_id"]] * (int(rate) + (coin < rate - int(rate)))
    ids = {d["doc_id"]: tokenizer.encode(d["text"], add_special_tokens=False).ids for d in docs}
    return sorted((i, ids[i]) for i in out)


def test_pipeline_equals_brute_force(spark):
    prepare(spark)
    got = sorted((r["doc_id"], r["ids"]) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert got == pipeline_by_hand(spark, SMALL) and len(got) > 50


def test_pipeline_stages_take_odd_rows(spark):
    prepare(spark)
    for rows in (ODD, []):
        docs = documents(spark, rows, extra=True)
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns or k == len(corpus_pipeline.STAGES) - 1
            out.collect()
