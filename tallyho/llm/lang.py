"""Language identification with bit-sliced Bloom filters of character n-grams.

One table holds the Bloom filters of all languages: slot i is a mask with bit L set when
language L's filter has bit i set.  An n-gram's probes are ANDed, which returns the mask of
all languages that contain it.  Per document and language, the hits are counted, corrected
for the filter's false positives, and the largest corrected count decides.

A language contains an n-gram if its relative frequency there is at least ``share`` of the
n-gram's highest relative frequency in any language.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batches, neutral

UNDETERMINED = "und"


# Characters whose n-grams are taken at once; a longer text is cut into pieces of this size.
SLICE = 1 << 18


@dataclass(frozen=True)
class Params:
    """``sizes`` (2 and up) of the n-grams; ``probes`` into 2**``slot_bits`` slots.

    The model is fitted on a hash-chosen sample of about ``sample`` labelled rows a language
    (all rows where there are fewer), whole texts.  An n-gram counts from ``least``
    occurrences in a language on, and each language keeps its ``grams`` most frequent.
    """

    sizes: tuple[int, ...] = (2, 3, 4)
    probes: int = 3
    slot_bits: int = 18
    sample: int = 2000
    grams: int = 20000
    least: int = 3
    share: float = 0.3
    sharpness: float = 0.5


@dataclass(frozen=True)
class Model:
    """``masks[slot]``: a byte for each 8 languages; ``false_rate[L]``: chance of a false hit in filter L."""

    languages: list[str]
    masks: np.ndarray
    false_rate: np.ndarray
    params: Params


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(32))


def _slices(texts: list[str | None]):
    """Lists of (number of the text, piece of it), each of about SLICE characters."""
    out, size = [], 0
    for i, text in enumerate(texts):
        text = (text or "").lower()
        for a in range(0, len(text), SLICE):
            out.append((i, text[a:a + SLICE]))
            size += len(out[-1][1])
            if size >= SLICE:
                yield out
                out, size = [], 0
    if out:
        yield out


def grams_of(pieces: list[tuple[int, str]], sizes: tuple[int, ...]):
    """For each n-gram size: keys of all n-grams, and the number of the text each belongs to.

    A stretch without letters is one gap, and so are the ends of a text.  An n-gram may have
    a gap only as its first or last place and has at least one letter.  Last comes an array
    of the letters' texts.
    """
    codes = np.frombuffer((" " + " ".join(p for _, p in pieces) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    of = np.repeat([i for i, _ in pieces], [len(p) + 1 for _, p in pieces])
    of = np.r_[of[0], of]
    letter = _letters()[codes]
    keep = letter | np.r_[True, letter[:-1]]
    codes = np.where(letter, codes, 0)[keep].astype(np.uint64)
    letter, of = letter[keep], of[keep]
    key, inner = codes, np.ones(len(codes), bool)
    for size in range(2, max(sizes) + 1):
        # key of the n-gram that begins here; its first place may be a gap, its inner ones may not
        key = key[:-1] * np.uint64(0x100000001B3) + codes[size - 1:]
        inner = inner[:-1] & letter[size - 2:-1] if size > 2 else letter[:-1] | letter[1:]
        if size in sizes:
            yield _mixed(key[inner] + np.uint64(size)), of[1:len(key) + 1][inner]
    yield None, of[letter]


def _counter(p: Params):
    def run(rows):
        for batch in batches(rows):
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for lang in sorted(set(langs)):
                found = [np.empty(0, np.uint64)]
                for pieces in _slices([t for t, x in zip(texts, langs) if x == lang]):
                    found += [k for k, _ in grams_of(pieces, p.sizes) if k is not None]
                keys, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)),
                                                  pa.array(counts.astype(np.int64))], names=["lang", "gram", "n"])
    return run


def _probes(keys: np.ndarray, p: Params):
    """The slots of each key, one array a probe."""
    step = (keys >> np.uint64(40)) | np.uint64(1)
    for i in range(p.probes):
        yield ((keys + np.uint64(i) * step) & np.uint64((1 << p.slot_bits) - 1)).astype(np.int64)


def build(languages: list[str], grams: dict[str, np.ndarray], p: Params = Params()) -> Model:
    """The bit-sliced filters of each language's n-gram keys."""
    masks = np.zeros((1 << p.slot_bits, max(1, -(-len(languages) // 8))), np.uint8)
    for i, lang in enumerate(languages):
        for slots in _probes(grams.get(lang, np.empty(0, np.uint64)), p):
            masks[slots, i // 8] |= np.uint8(1 << i % 8)
    filled = np.array([(masks[:, i // 8] >> i % 8 & 1).mean() for i in range(len(languages))])
    return Model(languages, masks, np.minimum(filled ** p.probes, 0.999), p)


def fit(labelled: DataFrame, p: Params = Params()) -> Model:
    """A model from ``labelled(doc_id, text, lang)``; rows without lang or text teach nothing.

    The driver gets one count a language, and of the bounded sample's n-grams at most
    ``grams`` keys a language.
    """
    rows = labelled.select("doc_id", F.col("text").cast("string"), F.col("lang").cast("string")).filter(
        "lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(counts, key=lambda x: (-counts[x], x))  # of equal scores the more frequent wins
    if not languages:
        return build([], {}, p)
    chance = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, p.sample / n)))])
    sample = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1 << 20)) < chance[F.col("lang")] * (1 << 20))
    per = (sample.select("lang", "text").mapInArrow(_counter(p), "lang string, gram long, n long")
           .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    of_lang, of_gram = Window.partitionBy("lang"), Window.partitionBy("gram")
    contained = (per.withColumn("rate", F.col("n") / F.sum("n").over(of_lang))
                 .withColumn("most", F.max("rate").over(of_gram))
                 .filter((F.col("n") >= p.least) & (F.col("rate") >= p.share * F.col("most")))
                 .withColumn("place", F.row_number().over(of_lang.orderBy(F.desc("n"), "gram")))
                 .filter(F.col("place") <= p.grams))
    keys: dict[str, list[int]] = {}
    for r in contained.select("lang", "gram").toLocalIterator():
        keys.setdefault(r["lang"], []).append(r["gram"])
    return build(languages, {k: np.array(v, np.int64).view(np.uint64) for k, v in keys.items()}, p)


def identify(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score (0 to 1) of each text."""
    p, many = model.params, len(model.languages)
    hits, total, letters = np.zeros((len(texts), many)), np.zeros(len(texts)), np.zeros(len(texts))
    for pieces in _slices(texts):
        # only the texts of this slice are counted
        first = pieces[0][0]
        span = slice(first, pieces[-1][0] + 1)
        for keys, of in grams_of(pieces, p.sizes):
            of, width = of - first, span.stop - first
            if keys is None:
                letters[span] += np.bincount(of, minlength=width)
                continue
            total[span] += np.bincount(of, minlength=width)
            got = None
            for slots in _probes(keys, p):
                got = model.masks[slots] if got is None else got & model.masks[slots]
            for i in range(many):
                hits[span, i] += np.bincount(of, weights=got[:, i // 8] >> i % 8 & 1, minlength=width)
    if not many:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    corrected = (hits - total[:, None] * model.false_rate) / (1 - model.false_rate)
    best = corrected.argmax(axis=1)
    score = 1 / np.exp(-p.sharpness * (corrected.max(axis=1, keepdims=True) - corrected)).sum(axis=1)
    return ([model.languages[b] if n else UNDETERMINED for b, n in zip(best, letters)], np.where(letters > 0, score, 0.0))


def _identifier(model):
    def run(rows):
        m = model.value
        for batch in batches(rows):
            lang, score = identify(batch.column(TEXT).to_pylist(), m)
            # the other columns pass as they are
            kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != TEXT]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(lang, pa.string()), pa.array(score)],
                                             names=[*(n for n in batch.schema.names if n != TEXT), PRED, SCORE])
    return run


TEXT, PRED, SCORE = "_lang_text", "_lang_pred", "_lang_score"


def with_language(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``_lang_pred`` and ``_lang_score``, from whole texts in one pass without a shuffle.

    A null text, or one without a letter, is `und` with score 0, and so is every text if
    nothing was learnt.  A text none of whose n-grams is known has all languages alike: the
    most frequent one, score one over their number.  Ties go to the more frequent language.
    """
    schema = T.StructType([*docs.schema.fields, T.StructField(PRED, T.StringType()), T.StructField(SCORE, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**slot_bits bytes for each 8 languages
    return docs.withColumn(TEXT, F.col("text").cast("string")).mapInArrow(_identifier(shared), schema)


def held_out(column: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text is 2 modulo 4 (null: no)."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document; learnt from those not held out."""
    rows = docs.select("doc_id", "text", "lang")
    model = fit(rows.filter(~held_out()), p)
    return (with_language(rows.select("doc_id", "text"), model)
            .select("doc_id", held_out().alias("held_out"), F.col(PRED).alias("lang_pred"), F.col(SCORE).alias("score")))


def keep_identified(docs: DataFrame, least_score: float = 0.5, p: Params = Params()) -> DataFrame:
    """The rows, all columns, whose language is identified with at least ``least_score``.

    Null texts and texts without a letter go; rows with a null or repeated doc_id are judged
    each.  Other columns may have any names; an empty table gives an empty result.
    """
    rows, back = neutral(docs, "doc_id", "text", "lang")
    model = fit(rows.filter(~held_out()), p)
    return back(with_language(rows, model).filter((F.col(PRED) != UNDETERMINED) & (F.col(SCORE) >= least_score)))
