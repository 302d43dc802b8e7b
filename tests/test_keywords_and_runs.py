"""Keyword tables, date columns by content, free-form dates, merged rollups and daily runs on small inputs."""

import datetime as dt
import os
import tempfile

import pytest

from pyspark.sql import functions as F

from tallyho.functions.dates import free_date, lenient_date
from tallyho.operators import diff, extract
from tallyho.operators import readings as ops
from tallyho.streaming import readings as stream


def _kept(spark, texts, keywords, gram=3):
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    kw = spark.createDataFrame([(k,) for k in keywords], "kw string")
    return sorted(r.id for r in extract.exclude_keyword_table(docs, "text", kw, gram).collect())


def test_keyword_table_equals_brute_force(spark):
    texts = ["", None, "a", "ab", "abc", "xxabcxx", "common begin one", "common begin two", "common begin", "資料庫錯誤 here",
             "𝒳𝒴𝒵 wide", "tail𝒴𝒵", "line\nbreak", "common begin one", "z" * 5000 + "needle" + "y" * 5000, "AB"]
    for keywords in (["common begin two", "common begin zzz", "資料庫", "needle", "𝒴𝒵 ", "e\nb"], ["b", "𝒵"], ["ab", "needle", ""],
                     [None, ""], [], ["absent words"], ["abc", "abc", "xxabcxxx"]):
        want = [i for i, t in enumerate(texts) if t is None or not any(k and k in t for k in keywords)]
        assert _kept(spark, texts, keywords) == want, keywords


def test_keyword_table_with_common_beginnings_and_copies(spark):
    texts = [f"error code {i % 40}!" for i in range(2000)]
    keywords = [f"error code {i}!" for i in range(0, 40, 2)]
    assert _kept(spark, texts, keywords) == [i for i in range(2000) if i % 40 % 2]


def test_keyword_rarest_gram(spark):
    texts = spark.createDataFrame([("abcd",), ("abce",), ("abcf",)], "_tly_text string")
    kw = spark.createDataFrame([("abcd",), ("abcx",), ("abc",)], "_tly_kw string")
    got = {r._tly_kw: r._tly_gram for r in extract.rarest_grams(texts, kw, [3]).collect()}
    assert got == {"abcd": "bcd", "abc": "abc"}


def test_date_columns_by_content(spark):
    rows = [("2024/1/5", "45292", "2024-01-05", "x", "", "2024-13-01", 1), ("2024-02-06 00:00:00", "7", "45292", "2024/1/1", None, "2024-01-01", 2),
            ("", None, "2024/3/4", "y", "", "2024-01-02", 3)]
    df = spark.createDataFrame(rows, "dates string, numbers string, mixed string, names string, blank string, broken string, n int")
    assert diff.date_columns(df) == ["dates", "mixed"]
    assert diff.date_columns(df, share=0.6) == ["broken", "dates", "mixed"]
    assert diff.date_columns(df.where("n = 0")) == []
    assert diff.date_columns(df.select("n")) == []
    # both sides decide together
    other = spark.createDataFrame([("soon",)], "dates string")
    assert diff.date_columns(df, other) == ["mixed"]
    shares = {r.column: (r.filled, sum(r.layouts), r.serials) for r in diff.date_shares(df).collect()}
    assert shares["mixed"] == (3, 2, 1) and shares["numbers"] == (2, 0, 2)


@pytest.mark.parametrize("text, want", [
    ("5 January 2024", (2024, 1, 5)), ("Jan 5, 2024", (2024, 1, 5)), ("05-jan-24", (2024, 1, 5)), ("5th Sept 1999", (1999, 9, 5)),
    ("Friday, 5 January 2024", (2024, 1, 5)), ("1/5/24", (2024, 1, 5)), ("13/5/24", (2024, 5, 13)), ("13.5.2024", (2024, 5, 13)),
    ("1/5/69", (1969, 1, 5)), ("2024 May 9", (2024, 5, 9)), ("2024-01-05T10:11:12.5Z", (2024, 1, 5)), ("1/5/2024 3:04 PM", (2024, 1, 5)),
    ("20240105101112", (2024, 1, 5)), ("2024-01-05 10:11:12+08:00", (2024, 1, 5)), ("august 2nd, 2024", (2024, 8, 2)),
    ("30 Feb 2024", None), ("2024-13-01", None), ("14/13/2024", None), ("1,500.25", None), ("45292", None), ("C12", None), ("", None),
    (None, None), ("marble 5 2024", None), ("=24 1 5", None), ("week 5 2024", None), ("12.50", None)])
def test_free_dates(spark, text, want):
    row = spark.createDataFrame([(text,)], "v string").select(free_date("v").alias("f"), lenient_date("v").alias("l")).first()
    want = want and dt.date(*want)
    assert row.l == want and row.f == want


def _replies(spark, rows):
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, rh double, temp_c double")
    return df.withColumn("reject_reason", F.when(F.col("rh") < 0, "not a number"))


def test_rollup_parts_merge_and_replay(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(i, t + dt.timedelta(minutes=(i * 37) % 300), 30.0 + i % 7 / 8, 15.0 - i % 5 / 4) for i in range(200)]
    rows += [(900, t, -1.0, 0.0)]
    out = stream.scratch_path(spark, "parts")
    write = stream.partial_writer(out)
    parts = [_replies(spark, rows[i::3]) for i in range(3)]
    for batch_id, part in enumerate(parts):
        write(part, batch_id)
    whole = ops.stats(ops.good(_replies(spark, rows).select("*", *[F.lit("").alias(c) for c in ("rh_unit", "trend", "temp_unit")])),
                      "hour").withColumnRenamed("hour", "bucket")
    want = sorted(map(tuple, whole.collect()))
    assert sorted(map(tuple, stream.merged_rollup(spark, out).select(whole.columns).collect())) == want
    write(parts[1], 1)   # a batch replayed after a failure
    assert sorted(map(tuple, stream.merged_rollup(spark, out).select(whole.columns).collect())) == want
    write(_replies(spark, [(901, t, 99.0, 1.0)]), 3)   # a late reply still counts
    assert stream.merged_rollup(spark, out).agg(F.sum("n"), F.max("rh_max")).first()[:] == (201, 99.0)


def test_run_days_survives_a_kill_between_both_writes(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="tallyho-days-")
    out, log = os.path.join(root, "out"), os.path.join(root, "log")
    data = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-02", 3)], "day string, v int") \
        .withColumn("day", F.to_date("day"))

    def job(rows):
        return rows.groupBy("day").agg(F.sum("v").alias("v"))

    def seen():
        return sorted((str(r.day), r.v, r.run) for r in stream.committed_days(spark, out, log).collect())

    stream.run_days(data.where("v = 1"), out, log, job, "a")
    assert seen() == [("2024-01-01", 1, "a")]
    with monkeypatch.context() as m:
        def killed(*_):
            raise RuntimeError("killed")
        m.setattr(stream, "record_runs", killed)
        with pytest.raises(RuntimeError):
            stream.run_days(data, out, log, job, "b")
    assert seen() == [("2024-01-01", 1, "a")]      # written, not committed
    stream.run_days(data, out, log, job, "c")
    assert seen() == [("2024-01-01", 1, "a"), ("2024-01-02", 5, "c")]
    stream.run_days(data, out, log, job, "d")      # nothing pending
    assert seen() == [("2024-01-01", 1, "a"), ("2024-01-02", 5, "c")]
