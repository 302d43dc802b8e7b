"""Extract, keyword exclusion, incremental pick and latest-file selection
(S3, S4, S9/O5/F11, P11, P13, J7).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.dates import name_timestamp
from ..functions.text import delimited_row
from ..session import landed

FILTER_WORDS = 1 << 14   # 64-bit words of the bitmap of keyword grams


def extract_top(df: DataFrame, order: list[str], n: int = config.EXTRACT_ROWS) -> DataFrame:
    """S9 + O5 + F11: the first ``n`` rows in a fixed order, each also as one
    tab-separated text line (missing values print as ``None``).  ``orderBy + limit`` is a
    distributed top-n (TakeOrderedAndProject), never a full sort to the driver."""
    cols = df.columns
    return df.orderBy(*order).limit(n).withColumn("line", delimited_row(cols))


def exclude_keywords(df: DataFrame, columns: list[str], keywords=config.EXCLUDE_KEYWORDS) -> DataFrame:
    """Drop rows where any of ``columns`` contains any keyword (case-sensitive).

    With a literal list this is a plain filter (pushed to the scan as string-contains
    predicates); for a keyword *table* use ``exclude_keyword_table``.
    """
    if not keywords:
        return df
    hit = reduce(lambda a, b: a | b, [F.coalesce(F.col(c).contains(k), F.lit(False))
                                      for c in columns for k in keywords])
    return df.where(~hit)


def _grams(text, sizes) -> Column:
    """The character runs of the given lengths, repeats included; each length is one scan of the text."""
    return F.concat(*[F.regexp_extract_all(text, F.lit(f"(?s)(?=({'.' * n}))"), F.lit(1)) for n in sizes])


def _bitmap(grams: DataFrame) -> DataFrame:
    """One row, an array of ``FILTER_WORDS`` numbers in which every gram sets one bit: its size does not depend on the table."""
    at = F.pmod(F.xxhash64("_tly_gram"), F.lit(FILTER_WORDS * 64))
    words = (grams.select(F.floor(at / 64).alias("_tly_word"), F.lit(1).cast("long").alias("_tly_one"),
                          (at % 64).cast("int").alias("_tly_at"))
             .groupBy("_tly_word").agg(F.expr("bit_or(shiftleft(_tly_one, _tly_at))").alias("_tly_set")))
    every = grams.sparkSession.range(FILTER_WORDS).withColumnRenamed("id", "_tly_word").join(words, "_tly_word", "left")
    filled = F.struct("_tly_word", F.coalesce("_tly_set", F.lit(0).cast("long")).alias("_tly_set"))
    return every.agg(F.array_sort(F.collect_list(filled))["_tly_set"].alias("_tly_bits"))


def _found(texts: DataFrame, sizes: list[int], known: DataFrame, *keep: str) -> DataFrame:
    """The grams of the texts (``_tly_text``), less nearly all that are not in ``known``."""
    at = F.pmod(F.xxhash64("_tly_gram"), F.lit(FILTER_WORDS * 64))
    word = F.get(_bitmap(known).scalar(), F.floor(at / 64).cast("int"))
    return (texts.select(*keep, F.explode(_grams(F.col("_tly_text"), sizes)).alias("_tly_gram"))
            .where(F.getbit(word, (at % 64).cast("int")) == 1))


def rarest_grams(texts: DataFrame, keywords: DataFrame, sizes: list[int], gram: int = 3) -> DataFrame:
    """Every keyword (``_tly_kw``) with the gram of it (``_tly_gram``) that occurs least in the texts (``_tly_text``),
    ties by the gram.  A keyword with a gram that does not occur is in no text and is left out."""
    own = F.when(F.length("_tly_kw") >= gram, _grams(F.col("_tly_kw"), [gram])).otherwise(F.array("_tly_kw"))
    parts = keywords.select("_tly_kw", F.explode(own).alias("_tly_gram"))
    held = (_found(texts, sizes, parts.select("_tly_gram").distinct())
            .groupBy("_tly_gram").agg(F.count(F.lit(1)).alias("_tly_n")))
    best = F.min(F.struct(F.coalesce("_tly_n", F.lit(0)).alias("n"), F.col("_tly_gram").alias("gram")))
    return (parts.join(held, "_tly_gram", "left").groupBy("_tly_kw").agg(best.alias("_tly_best"))
            .where("_tly_best.n > 0").select("_tly_kw", F.col("_tly_best.gram").alias("_tly_gram")))


def exclude_keyword_table(df: DataFrame, column: str, keywords: DataFrame, gram: int = 3) -> DataFrame:
    """P11 with keywords in a table of any size: rows whose text contains one are dropped.

    A text that contains a keyword holds all its runs of ``gram`` characters (a shorter keyword
    as a whole).  Each keyword is looked up by its run that occurs least, so keywords that begin
    alike do not meet in one hot key.  A bitmap of the wanted runs (128 KB, whatever the table)
    drops the others before the shuffle; pairs are then checked exactly on whole texts.  Only
    texts with a wanted run are compared, once for all copies; nothing is capped.  Empty and null keywords
    match nothing, null texts contain nothing and stay, repeated rows are each kept or dropped.
    """
    kw = keywords.select(F.col(keywords.columns[0]).cast("string").alias("_tly_kw")).where("_tly_kw <> ''").distinct()
    # at most ``gram`` numbers: the run lengths to look for
    sizes = sorted(r[0] for r in kw.select(F.least(F.length("_tly_kw"), F.lit(gram))).distinct().collect())
    if not sizes:
        return df
    keyed = df.withColumn("_tly_digest", F.unhex(F.sha2(F.col(f"`{column}`"), 256)))
    texts = keyed.select("_tly_digest", F.col(f"`{column}`").alias("_tly_text")).where("_tly_text is not null")
    chosen = landed(rarest_grams(texts, kw, sizes, gram), "keyword-grams")
    pairs = landed(_found(texts, sizes, chosen.select("_tly_gram").distinct(), "_tly_digest").distinct()
                   .join(chosen, "_tly_gram").select("_tly_digest", "_tly_kw"), "keyword-pairs")
    hits = (texts.join(pairs, "_tly_digest", "left_semi").dropDuplicates(["_tly_digest"]).join(pairs, "_tly_digest")
            .where(F.contains("_tly_text", "_tly_kw")).select("_tly_digest").distinct())
    return keyed.join(hits, "_tly_digest", "left_anti").drop("_tly_digest")


def incremental_pick(source: DataFrame, manifest: DataFrame, name: str = "name", mtime: str = "mtime") -> DataFrame:
    """J7 (re-aimed file sync): source entries missing from the manifest or newer there."""
    m = manifest.select(F.col(name).alias("_tly_name"), F.col(mtime).alias("_tly_mtime"))
    joined = source.join(m, source[name] == m["_tly_name"], "left")
    reason = (F.when(F.col("_tly_mtime").isNull(), F.lit("missing"))
              .when(F.col(mtime) > F.col("_tly_mtime"), F.lit("newer")))
    return (joined.withColumn("reason", reason).where(F.col("reason").isNotNull())
            .drop("_tly_name", "_tly_mtime"))


def latest_per_folder(listing: DataFrame, path: str = "path", folder: str = "folder",
                      mtime: str = "modificationTime", use_name_time: bool = True) -> DataFrame:
    """S3 + S4: newest file per folder -- by the timestamp in its name (``TOTAL_yyyyMMdd_HHmm``)
    when present, else by modification time; ties broken by path.  One aggregate with a
    struct maximum: partial per partition, so a huge folder is not one task."""
    ts = F.coalesce(name_timestamp(F.col(path)), F.col(mtime).cast("timestamp")) if use_name_time \
        else F.col(mtime).cast("timestamp")
    best = F.max(F.struct(ts.alias("ts"), F.col(path).alias("path")))
    return (listing.groupBy(folder).agg(best.alias("_tly_best"))
            .select(folder, F.col("_tly_best.path").alias("latest_file"), F.col("_tly_best.ts").alias("file_ts")))
