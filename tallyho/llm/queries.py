"""The operators as queries ``(spark, sf_dir) -> DataFrame`` over whole tables, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, embeddings, lang, manifest, minhash, mixing, pii, quality_model, quality_rules, url_filter, warc, whitening
from .common import landed, prepare, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def vocabulary() -> str:
    """Path of the word BPE vocabulary: $TALLYHO_VOCABULARY, else that of the installed public tokenizers."""
    if path := os.environ.get("TALLYHO_VOCABULARY"):
        return path
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def query(name: str):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        return fn
    return register


@query("op1_bpe")
def op1(spark, sf_dir):
    """Token counts and digests of every document's ids and decoded text."""
    return bpe.digest_documents(read(spark, sf_dir, "documents"), vocabulary())


@query("op2_language")
def op2(spark, sf_dir):
    """Predicted language of every document, learnt from those not held out."""
    return lang.predict(read(spark, sf_dir, "documents"))


@query("op3_minhash")
def op3(spark, sf_dir):
    """Near-duplicate components of all documents."""
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


@query("op4_mixing")
def op4(spark, sf_dir):
    """What the mixture takes of every document."""
    return mixing.mix_sizes(read(spark, sf_dir, "documents"))


@query("op5_quality_model")
def op5(spark, sf_dir):
    """Calibrated quality score of every document."""
    return quality_model.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op6_quality_rules")
def op6(spark, sf_dir):
    """The rule ledger of every document with the verdict of the current policy."""
    rows = quality_rules.verdicts(quality_rules.ledger(read(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def damaged(rows: DataFrame) -> DataFrame:
    """Records of which some have their last payload byte changed, as on a failing disk."""
    hit = F.pmod(F.crc32(F.col("page_id").cast("string").cast("binary")), F.lit(97)) == 5
    return rows.withColumn("record", F.when(hit, F.expr(
        "concat(substring(record, 1, octet_length(record) - 5), cast(if(substring(record, octet_length(record) - 4, 1) = "
        "cast('?' as binary), '!', '?') as binary), substring(record, octet_length(record) - 3, 4))")).otherwise(F.col("record")))


@query("op7_warc_fixity")
def op7(spark, sf_dir):
    """Faults of a second copy of all pages' records, found from differing tree branches.

    The copy has some records changed in place, and of each fifth archive the end is lost.
    """
    rows = warc.records(read(spark, sf_dir, "pages", "page_id", "url", "html"))
    left = landed(warc.index(rows), "left")
    lost = (F.pmod("archive", F.lit(5)) == 2) & (F.col("nth") >= 4000)
    right = landed(warc.index(damaged(rows)).filter(~lost), "right")
    return warc.located(warc.audit(left, right), left, right)


@query("op8_chat")
def op8(spark, sf_dir):
    """Digests of every conversation, read back from its formatted text."""
    table = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], table.schema)
    return chat.digests(chat.format_conversations(table.unionByName(extra)))


@query("op9_embeddings")
def op9(spark, sf_dir):
    """Near-duplicate components and link counts of all vectors."""
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"))


@query("op10_url_filter")
def op10(spark, sf_dir):
    """Host, path, rule and verdict of every page."""
    return url_filter.judge(read(spark, sf_dir, "pages"))


@query("op11_whitening")
def op11(spark, sf_dir):
    """Whitened components of all vectors."""
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


@query("op12_pii")
def op12(spark, sf_dir):
    """Counts and spans of personal data in every document."""
    return pii.digests(read(spark, sf_dir, "documents"))


def tampered(docs: DataFrame) -> dict:
    """A copy in which some documents' texts have lost their capitals."""
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return {"text": F.when(hit, lower).otherwise(F.col("text"))}


@query("op13_manifest")
def op13(spark, sf_dir):
    """Leaf, roots and proof of every document, and the root a tampered copy folds to."""
    docs = read(spark, sf_dir, "documents")
    return manifest.manifest(docs, tampered(docs))
