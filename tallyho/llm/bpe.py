"""BPE encoding and decoding by batched numpy merge rounds.

The words of a batch that are not yet known are merged together: their symbols lie in one
flat array, each round looks up every adjacent pair's rank by binary search over the sorted
pair keys, finds each word's lowest rank and merges there.  Known words come from a bounded
table, so a text is looked up word by word and only new words are merged.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches

# Words in a task's table, and characters of text whose new words are merged together.
TABLE_SIZE = 1 << 18
SLICE = 1 << 20
# Texts of characters below this one are in NFC and can be split by the standard, faster re module.
PLAIN_END = 0x180
# Bytes of UTF-8 that such texts consist of.
BELOW_PLAIN_END = bytes(range(0xC6))
NO_RANK = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others take the code points from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@dataclass
class Vocabulary:
    """The tables of a tokenizer file, ready for merge rounds.

    ``pair_keys`` are ``left * n + right`` in ascending order, ``pair_ranks`` and
    ``pair_ids`` the rank and the merged symbol at the same places.  ``at_once[rank]`` says
    that no pair with the merged symbol has a lower rank: all its places may then be merged
    in the same round; else only the leftmost, as a merge one by one would.
    """

    tokens: list[str]
    specials: dict[str, int]
    split: regex.Pattern
    split_plain: re.Pattern
    newer: regex.Pattern
    split_newer: regex.Pattern
    first: np.ndarray
    last: np.ndarray
    pair_keys: np.ndarray
    pair_ranks: np.ndarray
    pair_ids: np.ndarray
    at_once: np.ndarray


#: Letters and numbers to the regex module that the tokenizers library, whose tables are older, counts
#: as neither: code points, or first and last of a range.
NEWER_LETTERS = [
    0x558, (0x58B, 0x58C), 0x88F, 0xC5C, 0xCDC, 0x208F, (0x209D, 0x209F), (0xA7CE, 0xA7CF), 0xA7D2, 0xA7D4,
    0xA7DD, 0xA7E2, 0xA7F1, (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), 0x11B0A, (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), 0x11DF1, 0x1246F, (0x12475, 0x1247F),
    (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF),
    (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2),
    (0x1B123, 0x1B128), 0x1B168, 0x1D6A6, (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD,
    0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0,
    0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), 0x2B81E, (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000,
    0x3FC3F),
]


def _newer_letters() -> str:
    """The inside of a pattern's class with NEWER_LETTERS."""
    ranges = [x if isinstance(x, tuple) else (x, x) for x in NEWER_LETTERS]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


#: Capitals newer than Python's tables -> what the tokenizers library makes of them.
NEWER_CAPITALS = str.maketrans({
    0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB,
    0xA7DC: 0x019B, **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}})


def _plain_class(of: str) -> str:
    """The inside of a class of the re module: characters below PLAIN_END of a property."""
    return "".join(f"\\u{c:04x}" for c in range(PLAIN_END) if regex.match(of, chr(c)))


def parse_vocabulary(content: str) -> Vocabulary:
    """A vocabulary from the JSON of a byte-level BPE tokenizer file with word ends."""
    spec = json.loads(content)
    model, ids = spec["model"], dict(spec["model"]["vocab"])
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [""] * (max([*ids.values(), *specials.values()]) + 1)
    for token, i in [*ids.items(), *specials.items()]:
        tokens[i] = token
    end = model.get("end_of_word_suffix") or ""
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    n = len(tokens)
    left = np.array([ids[a] for a, _ in pairs], np.int64)
    right = np.array([ids[b] for _, b in pairs], np.int64)
    made = np.array([ids[a + b] for a, b in pairs], np.int64)
    ranks = np.arange(len(pairs))
    least = np.full(n, NO_RANK)  # the lowest rank of a pair that a symbol takes part in
    np.minimum.at(least, left, ranks)
    np.minimum.at(least, right, ranks)
    order = np.argsort(left * n + right)
    symbols, newer = byte_symbols(), _newer_letters()
    pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    older = (pattern.replace(r"[^\s\p{L}\p{N}]", rf"[[^\s\p{{L}}\p{{N}}]||[{newer}]]")
             .replace(r"[\p{L}]", rf"[\p{{L}}--[{newer}]]").replace(r"[\p{N}]", rf"[\p{{N}}--[{newer}]]"))
    # the same alternatives for plain texts: no two kinds begin alike, but for the ones after an apostrophe
    letters, numbers, space = (_plain_class(x) for x in (r"\p{L}", r"\p{N}", r"\s"))
    plain = pattern.replace("[^\\s\\p{L}\\p{N}]", f"[^{space}{letters}{numbers}]").replace("[\\p{L}]", f"[{letters}]")
    plain = plain.replace("[\\p{N}]", f"[{numbers}]")
    return Vocabulary(
        tokens, specials, regex.compile(pattern), re.compile(plain), regex.compile(f"[{newer}]"), regex.compile(older, regex.V1),
        np.array([ids[s] for s in symbols], np.int64), np.array([ids[s + end] for s in symbols], np.int64),
        (left * n + right)[order], ranks[order], made[order], least[made] > ranks)


def _ranked(v: Vocabulary, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each pair (NO_RANK: none) and the symbol it makes."""
    key = left * len(v.tokens) + right
    at = np.minimum(np.searchsorted(v.pair_keys, key), len(v.pair_keys) - 1)
    hit = v.pair_keys[at] == key
    return np.where(hit, v.pair_ranks[at], NO_RANK), v.pair_ids[at]


def merge_words(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of (non-empty) words, all in one array, and the place where each word ends."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(words), np.uint8)
    symbols = v.first[flat]
    ends = np.cumsum(lengths) - 1
    symbols[ends] = v.last[flat[ends]]
    word = np.repeat(np.arange(len(words)), lengths)
    # rank and product of the pair that begins at each symbol; the last of a word begins none
    rank, made = np.full(len(symbols), NO_RANK), np.zeros(len(symbols), np.int64)
    fresh = np.flatnonzero(word[:-1] == word[1:])
    done_ids, done_words = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while len(symbols):
        rank[fresh], made[fresh] = _ranked(v, symbols[fresh], symbols[fresh + 1])
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(symbols)]))
        ended = best == NO_RANK
        done_ids.append(symbols[ended])
        done_words.append(word[ended])
        place = np.flatnonzero((rank == best) & ~ended)
        # the second of two overlapping places isn't merged: of a run, every other one is
        run = np.flatnonzero(np.r_[True, (np.diff(place) != 1) | (np.diff(word[place]) != 0)][:len(place)])
        step = np.arange(len(place)) - np.repeat(run, np.diff(np.r_[run, len(place)]))
        place = place[step % 2 == 0]
        leftmost = np.r_[True, np.diff(word[place]) != 0][:len(place)]
        place = place[v.at_once[rank[place]] | leftmost]
        symbols[place] = made[place]
        rank[place] = rank[place + 1]  # of a word's last symbol it says that no pair begins there
        keep = ~ended
        keep[place + 1] = False
        new_place = (np.cumsum(keep) - 1)[place]
        symbols, word, rank, made = symbols[keep], word[keep], rank[keep], made[keep]
        # only the pairs beside a merged symbol have changed
        fresh = np.unique(np.r_[new_place, new_place - 1])
        fresh = fresh[(fresh >= 0) & (fresh < len(symbols) - 1)]
        fresh = fresh[word[fresh] == word[fresh + 1]]
    ids, of = np.concatenate(done_ids), np.concatenate(done_words)
    return ids[np.argsort(of, kind="stable")], np.cumsum(np.bincount(of, minlength=len(words)))


class Words:
    """Token ids of the words met so far: word -> number, and all ids in one array by number.

    At TABLE_SIZE words the table begins anew, which bounds a task's memory.
    """

    def __init__(self, v: Vocabulary):
        self.v = v
        self.text = [str(i) for i in range(len(v.tokens))]
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.ends = np.empty(0, np.int64), np.zeros(1, np.int64)  # ends[i + 1]: where word i ends
        for token, i in self.v.specials.items():
            self._add([token], np.array([i]), np.array([1]))

    def _add(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words))))
        self.ids, self.ends = np.r_[self.ids, ids], np.r_[self.ends, ends + self.ends[-1]]

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words in order, and how many each has; new words are merged together."""
        distinct = set(words)
        new = [w for w in distinct if w not in self.number]
        if len(self.number) + len(new) > TABLE_SIZE:
            self._clear()
            new = [w for w in distinct if w not in self.number]
        if new:
            self._add(new, *merge_words([w.encode() for w in new], self.v))
        at = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        start, count = self.ends[at], self.ends[at + 1] - self.ends[at]
        # the place of each id: its word's start, counted on within the word
        first = np.cumsum(count) - count
        return self.ids[np.arange(count.sum()) + np.repeat(start - first, count)], count


def words_of(text: str | None, v: Vocabulary) -> list[str]:
    """The words of a text after normalising: NFC, then lower case, each character by itself.

    Special tokens in the text are words of their own.
    """
    if not text:
        return []
    if any(s in text for s in v.specials):
        parts = regex.split("(" + "|".join(map(regex.escape, v.specials)) + ")", text)
        return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else words_of(part, v))]
    if text.isascii() or not text.encode().translate(None, BELOW_PLAIN_END):
        return v.split_plain.findall(text.lower())
    # lower() makes a final sigma of a capital sigma at the end of a word; the library doesn't
    text = unicodedata.normalize("NFC", text).replace("Σ", "σ").translate(NEWER_CAPITALS).lower()
    return (v.split_newer if v.newer.search(text) else v.split).findall(text)


def encode_slices(texts: Iterable[str | None], table: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Token ids of texts, and where each text's ids end, for about SLICE characters of texts at once."""
    def ready(words, ends):
        ids, count = table.ids_of(words)
        return ids, np.r_[0, np.cumsum(count)][np.array(ends, np.int64)]

    words, ends, size = [], [], 0
    for text in texts:
        words += words_of(text, table.v)
        ends.append(len(words))
        size += len(text or "")
        if size > SLICE:
            yield ready(words, ends)
            words, ends, size = [], [], 0
    if ends:
        yield ready(words, ends)


def encode(texts: Iterable[str | None], table: Words) -> Iterator[list[int]]:
    """Token ids of each text.  The new words of about SLICE characters of text are merged together."""
    for ids, ends in encode_slices(texts, table):
        ids, ends = ids.tolist(), ends.tolist()
        for a, b in zip([0, *ends], ends):
            yield ids[a:b]


def decode(ids: Iterable[int], v: Vocabulary) -> str:
    """The tokens joined by one space; null or unknown numbers are passed over."""
    return " ".join([v.tokens[i] for i in ids if i is not None and 0 <= i < len(v.tokens)])


@lru_cache(maxsize=1)
def _vocabulary(content: str) -> Vocabulary:
    """A Python worker's vocabulary, kept from one task to the next; the words met belong to a task."""
    return parse_vocabulary(content)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _digester(content):
    def run(rows):
        table = Words(_vocabulary(content.value))
        number, token = table.text, table.v.tokens
        for batch in batches(rows):
            got = [(len(ids), _sha256(" ".join([number[i] for i in ids])), _sha256(" ".join([token[i] for i in ids])))
                   for ids in encode((row.as_py() for row in batch.column("text")), table)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.string()),
                 pa.array([g[2] for g in got], pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _encoder(content):
    def run(rows):
        table = Words(_vocabulary(content.value))
        for batch in batches(rows):
            ids, ends, total = [np.empty(0, np.int32)], [np.zeros(1, np.int64)], 0
            for slice_ids, slice_ends in encode_slices((row.as_py() for row in batch.column("text")), table):
                ids.append(slice_ids.astype(np.int32))
                ends.append(slice_ends + total)
                total += len(slice_ids)
            at = np.concatenate(ends)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(at)),
                 pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(np.concatenate(ids)))],
                names=["doc_id", "n_tokens", "ids"])
    return run


def _decoder(content):
    def run(rows):
        v = _vocabulary(content.value)
        for batch in batches(rows):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([decode(x.as_py() or [], v) for x in batch.column("ids")], pa.string())],
                names=["doc_id", "decoded"])
    return run


def _shared(spark: SparkSession, vocabulary: str):
    """The vocabulary file's content on every executor (a few MB, whatever the input is)."""
    with open(vocabulary, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_tokens, ids array<int>`` of every whole text; null and empty texts have no tokens."""
    return _input(docs).mapInArrow(_encoder(_shared(docs.sparkSession, vocabulary)), "doc_id long, n_tokens long, ids array<int>")


def decode_documents(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, decoded`` from ``doc_id, ids``; null ids give an empty text."""
    return tokens.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(
        _decoder(_shared(tokens.sparkSession, vocabulary)), "doc_id long, decoded string")


def digest_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every whole text.

    A null or empty text has no tokens and the digests of the empty string; rows with a null
    or repeated doc_id are encoded like any other; other columns are not read; an empty table
    gives an empty result.  One pass without a shuffle: a task holds one Arrow batch and a
    bounded word table.
    """
    return _input(docs).mapInArrow(_digester(_shared(docs.sparkSession, vocabulary)),
                                   "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
