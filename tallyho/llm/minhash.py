"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard confirmation.

Two permutations make the whole signature.  The first spreads shingles over ``SLOTS``
positions; the second is one fixed table ``pi`` read circularly: coordinate k of a document
is the smallest ``pi[position + k]`` over its shingles, i.e. one contiguous run of the table
per shingle gives all coordinates at once.

Documents with equal shingle sets form one class from the start, so copies never meet in a
bucket.  Classes that share a band are candidates.  Candidates are confirmed on their full
sets in rounds that never list all pairs of a bucket: first each class meets one
partner in each of its buckets, twice.  The classes of buckets that still hold several
components are then joined exactly: they are cut into blocks of bounded size, blocks whose
classes share one of their rarest shingles, as sets that reach the threshold do, are
compared as a whole, a strip of rows at a time, and links are returned that connect what
the pairs connect.  Pairs already connected need no test, so no connection among
candidates is lost.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_words, batches, groups, is_word_text, landed
from .components import components

SLOTS = 1 << 20
WORD_CACHE = 1 << 18
# Cells of the matrix of intersections that are held at once when blocks are compared, whatever the classes in a block.
CELLS = 1 << 22
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
                dtype=np.uint64)


@dataclass(frozen=True)
class Params:
    """``shingle`` words a shingle, link at ``100 * intersection >= percent * union``.

    With 32 bands of 4 rows a pair at similarity 0.75 shares no band once in about 190,000
    times.  ``max_bits`` is the number of differing one-bit coordinates (of 128) above which
    a candidate pair can't reach the threshold: 16 are expected at 0.75, and 41 is 6.7
    standard deviations more.  ``crowd`` is the size of the groups in which a large
    bucket's classes meet a common partner, ``block`` the number of shingles of the blocks
    that are compared exactly.
    """

    shingle: int = 5
    percent: int = 75
    bands: int = 32
    rows: int = 4
    max_bits: int = 41
    crowd: int = 64
    block: int = 200_000
    seed: int = 20


class _WordHashes(dict):
    """Word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, size: int, cache: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's ``size``-word shingles.

    A text with fewer words has its whole sequence as the one shingle; one without words none.
    """
    words = ascii_words(text)
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - size + 1)
    total = np.zeros(n, np.uint64)
    for i in range(min(size, len(words))):
        # a rotation keeps the position of each word in the sum
        total = _mixed(total + hashes[i:i + n] * _MIX[i % 5])
    if len(words) < size:
        total = _mixed(total + np.uint64(len(words)))
    return np.unique(total)


@lru_cache(maxsize=2)
def _circle(coordinates: int, seed: int) -> np.ndarray:
    """View of the second permutation whose row s holds its ``coordinates`` values from s on."""
    pi = np.random.default_rng(seed).permutation(SLOTS).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[:coordinates - 1]]), coordinates)


def signature(shingles: np.ndarray, p: Params) -> np.ndarray:
    """All coordinates of a non-empty shingle set."""
    circle = _circle(p.bands * p.rows, p.seed)
    slots = (shingles % np.uint64(SLOTS)).astype(np.int64)
    out = circle[slots[:4096]].min(axis=0)
    for i in range(4096, len(slots), 4096):
        np.minimum(out, circle[slots[i:i + 4096]].min(axis=0), out=out)
    return out


def _band_keys(sigs: np.ndarray, p: Params) -> np.ndarray:
    """One 64-bit key a band, from its rows and its number."""
    rows = sigs.astype(np.uint64).reshape(-1, p.bands, p.rows)
    key = np.broadcast_to(np.arange(1, p.bands + 1, dtype=np.uint64), rows.shape[:2])
    for r in range(p.rows):
        key = _mixed(key * _MIX[0] + rows[:, :, r])
    return key.view(np.int64)


def _sketcher(p: Params):
    def run(rows):
        cache = _WordHashes()
        for batch in batches(rows):
            n = batch.num_rows
            count, digest = np.zeros(n, np.int64), np.zeros((n, 2), np.int64)
            sigs = np.zeros((n, p.bands * p.rows), np.uint32)
            for i, text in enumerate(batch.column("text")):
                s = shingle_set(text.as_py(), p.shingle, cache)
                count[i] = len(s)
                if len(s):
                    digest[i] = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                    sigs[i] = signature(s, p)
            bits = np.packbits((sigs & 1).astype(np.uint8), axis=1)
            bits = np.pad(bits, ((0, 0), (0, max(0, 16 - bits.shape[1]))))[:, :16].copy().view(np.int64)
            keys = _band_keys(sigs, p)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count), pa.array(digest[:, 0]), pa.array(digest[:, 1]),
                 pa.array(bits[:, 0]), pa.array(bits[:, 1]),
                 pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * p.bands), pa.array(keys.ravel()))],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bits_a", "bits_b", "bands"])
    return run


def sketches(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """Per row: set size, a 128-bit digest of the set, 128 one-bit coordinates and the band keys."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _sketcher(p), "doc_id long, n_shingles long, set_a long, set_b long, bits_a long, bits_b long, bands array<long>")


def _confirmer(p: Params):
    def run(rows):
        cache, last, left = _WordHashes(), None, None
        for batch in batches(rows):
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            keep = np.zeros(batch.num_rows, bool)
            ta, tb = batch.column("text_a"), batch.column("text_b")
            for i, x in enumerate(a):
                if (text := ta[i].as_py()) != last:  # rows of one left document follow each other
                    last, left = text, shingle_set(text, p.shingle, cache)
                right = shingle_set(tb[i].as_py(), p.shingle, cache)
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep[i] = both > 0 and 100 * both >= p.percent * (len(left) + len(right) - both)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(a, np.int64)[keep]), pa.array(np.array(b, np.int64)[keep])],
                                             names=["a", "b"])
    return run


def confirmed(pairs: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """The pairs ``(a, b)`` whose full shingle sets reach the threshold."""
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    return pairs.join(right, "b").join(left, "a").select("a", "text_a", "b", "text_b").mapInArrow(
        _confirmer(p), "a long, b long")


def _near(x: str, y: str, p: Params):
    """A necessary condition for a link: set sizes allow it, and few one-bit coordinates differ."""
    differ = (F.bit_count(F.col(f"{x}.bits_a").bitwiseXOR(F.col(f"{y}.bits_a")))
              + F.bit_count(F.col(f"{x}.bits_b").bitwiseXOR(F.col(f"{y}.bits_b"))))
    few = differ <= p.max_bits if p.bands * p.rows >= 128 else F.lit(True)
    return ((F.least(f"{x}.n", f"{y}.n") * 100 >= F.greatest(f"{x}.n", f"{y}.n") * p.percent) & few)


def _partners(members: DataFrame, p: Params, round_: int) -> DataFrame:
    """One partner for each class in each bucket: the smallest of its group of about ``crowd``."""
    groups = F.ceil(F.col("size") / p.crowd)
    group = F.pmod(F.xxhash64("id", "key", F.lit(round_)), groups)
    w = Window.partitionBy("key", "_group").orderBy("id")
    it = F.struct("id", "n", "bits_a", "bits_b", "comp")
    met = (members.withColumn("_group", group).select(it.alias("y"), F.first(it).over(w).alias("x")))
    return (met.filter((F.col("x.id") < F.col("y.id")) & (F.col("x.comp") != F.col("y.comp")) & _near("x", "y", p))
            .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct())


def _with_components(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component."""
    found = landed(components(links).select("id", F.col("component").alias("_found")), "components")
    labelled = landed(members.drop("comp").join(found, "id", "left")
                      .withColumn("comp", F.coalesce("_found", "id")).drop("_found"), "members")
    mixed = (labelled.groupBy("key").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi"))
             .filter("_lo < _hi").select("key"))
    return landed(labelled.join(landed(mixed, "mixed"), "key", "left_semi"), "members")


def _setter(p: Params):
    def run(rows):
        cache = _WordHashes()
        for batch in batches(rows):
            sets = [shingle_set(t.as_py(), p.shingle, cache).view(np.int64) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.fromiter(map(len, sets), np.int64, len(sets))),
                 pa.array(np.fromiter((xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets), np.uint64, len(sets)).view(np.int64)),
                 pa.array(sets, pa.list_(pa.int64()))], names=["id", "n", "set", "keys"])
    return run


def _flat(sets: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of some sets, and the number of the set of each."""
    return sets.flatten().to_numpy(), np.repeat(np.arange(len(sets)), np.diff(sets.offsets.to_numpy()))


def _strips(left: pa.ListArray, right: pa.ListArray, cells: int):
    """Sizes of the intersections of all sets on the left with all on the right, by rows of at most about ``cells``.

    Yields the first row's number and the rows; only one strip exists at a time.
    """
    rk, ro = _flat(right)
    order = np.argsort(rk, kind="stable")
    rk, ro = rk[order], ro[order]
    height = max(1, cells // max(1, len(right)))
    for top in range(0, len(left), height):
        strip = left.slice(top, height)
        lk, lo = _flat(strip)
        first = np.searchsorted(rk, lk, "left")
        many = np.searchsorted(rk, lk, "right") - first
        lo, first, many = lo[many > 0], first[many > 0], many[many > 0]
        out = np.zeros(len(strip) * len(right), np.int64)
        upto = np.cumsum(many)
        a = 0
        while a < len(many):  # at most about 4M meetings at once
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + (1 << 22))))
            n = many[a:b]
            at = np.arange(n.sum()) + np.repeat(first[a:b] - (np.cumsum(n) - n), n)
            out += np.bincount(np.repeat(lo[a:b], n) * len(right) + ro[at], minlength=len(out))
            a = b
        yield top, out.reshape(len(strip), len(right))


def _overlaps(left: pa.ListArray, right: pa.ListArray) -> np.ndarray:
    """Sizes of the intersections of all sets on the left with all on the right."""
    return np.concatenate([np.zeros((0, len(right)), np.int64), *(rows for _, rows in _strips(left, right, CELLS))])


def _block_links(table: pa.Table, p: Params, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all components of a group that its pairs connect; a group is one or two blocks.

    Components that a link joins count as one from then on, so there are fewer links than
    components, however many pairs reach the threshold.
    """
    own = table.column("own").to_numpy(zero_copy_only=False)
    left = np.flatnonzero(own)
    right = left if table.column("block_x")[0] == table.column("block_y")[0] else np.flatnonzero(~own)
    ids, n = (table.column(c).to_numpy() for c in ("id", "n"))
    comps = table.column("comp").to_numpy().copy()
    sets = table.column("keys").combine_chunks()
    out: list[np.ndarray] = []
    for top, both in _strips(sets.take(pa.array(left)), sets.take(pa.array(right)), cells):
        rows = left[top:top + len(both)]
        union = n[rows][:, None] + n[right][None, :] - both
        linked = (both > 0) & (100 * both >= p.percent * union) & (comps[rows][:, None] != comps[right][None, :])
        for r in np.flatnonzero(linked.any(axis=1)):
            i, j = rows[r], right[linked[r]]
            joined, once = np.unique(comps[j], return_index=True)
            new = joined != comps[i]
            if new.any():
                j = j[once[new]]
                out.append(np.c_[np.full(len(j), ids[i]), ids[j]])
                comps[np.isin(comps, joined)] = comps[i]
    pairs = np.concatenate([np.empty((0, 2), np.int64), *out])
    return pairs[:, 0], pairs[:, 1]


def _block_comparer(p: Params):
    def run(rows):
        for table in groups(rows, ["block_x", "block_y"]):
            a, b = _block_links(table, p)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
    return run


def _contested_links(members: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """Links between the components of ``members``, whose buckets hold several: they connect what any pair connects.

    A class is at home in its largest bucket.  A home's classes are cut into blocks, those of
    its largest component apart from the others, so that blocks of one component never meet.
    Two blocks meet if they share a key of some class's rarest: of n shingles in one order for
    all, here by frequency among these classes, two sets that reach the threshold share one
    of the first n - ceil(percent * n / 100) + 1.

    An id whose rows have different texts has several sets; each is measured and ordered on its own.
    """
    largest = F.max_by("key", F.struct("size", "key")).alias("home")
    homed = landed(members.groupBy("id", "comp").agg(largest, F.sum_distinct("n").alias("n")), "homed")
    sizes = homed.groupBy("home", "comp").agg(F.sum("n").alias("_n"))
    home = landed(sizes.groupBy("home").agg(F.max_by("comp", F.struct("_n", "comp")).alias("_major"), F.sum("_n").alias("_total")), "homes")
    single = F.when(F.col("comp") == F.col("_major"), F.col("comp"))
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("_total") / p.block))
    classes = landed(homed.join(home, "home").select("id", "comp", single.alias("single"),
                                                     F.xxhash64("home", single.isNull(), part).alias("block")), "contested")
    own = texts.join(classes.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    sets = landed(own.mapInArrow(_setter(p), "id long, n long, set long, keys array<long>").join(classes, "id"), "sets")
    keys = sets.select("id", "set", "n", "block", "single", "comp", F.explode("keys").alias("key"))
    shared = landed(keys.groupBy("key").agg(F.count(F.lit(1)).alias("df")), "shared")
    place = F.dense_rank().over(Window.partitionBy("id", "set").orderBy("df", "key"))  # rows may repeat a set
    need = F.floor((F.col("n") * p.percent + 99) / 100)
    rarest = keys.join(shared, "key").withColumn("_place", place).filter("df > 1").filter(F.col("_place") <= F.col("n") - need + 1)
    by_block = landed(rarest.groupBy("key", "block", "single").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")), "rarest")
    x, y = by_block.alias("x"), by_block.alias("y")
    apart = (F.least("x.lo", "y.lo") < F.greatest("x.hi", "y.hi")) & ~(F.coalesce(F.col("x.single") == F.col("y.single"), F.lit(False)))
    pairs = landed(x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.block") <= F.col("y.block")) & apart)
                   .select(F.col("x.block").alias("block_x"), F.col("y.block").alias("block_y")).distinct(), "meetings")
    sides = (pairs.withColumn("block", F.col("block_x")).withColumn("own", F.lit(True))
             .union(pairs.filter("block_x <> block_y").withColumn("block", F.col("block_y")).withColumn("own", F.lit(False))))
    met = sides.join(sets.select("block", "id", "n", "comp", "keys"), "block")
    return (met.repartition("block_x", "block_y").sortWithinPartitions("block_x", "block_y")
            .mapInArrow(_block_comparer(p), "a long, b long"))


def _grouped(docs: DataFrame, p: Params) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, component_id`` of every row: components of texts, named by their smallest id."""
    rows = landed(sketches(docs, p), "sketches")
    classes = landed(
        rows.filter("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b")
        .agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies"),
             F.min_by(F.struct("n_shingles", "bits_a", "bits_b", "bands"), "doc_id").alias("of")), "classes")
    banded = classes.select("id", F.explode("of.bands").alias("key"))
    shared = landed(banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "buckets")
    held = landed(banded.join(shared, "key"), "banded")
    about = classes.select("id", F.col("of.n_shingles").alias("n"), "of.bits_a", "of.bits_b")
    members = landed(held.join(about, "id").withColumn("comp", F.col("id")), "members")
    wanted = landed(members.select(F.col("id").alias("doc_id")).distinct(), "wanted")
    texts = landed(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                   .join(wanted, "doc_id", "left_semi"), "texts")

    links = tried = None
    for round_ in (1, 2):
        pairs = _partners(members, p, round_)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        tried = landed(pairs, "pairs")
        new = landed(confirmed(tried, texts, p), "confirmed")
        links = new if links is None else links.union(new)
        members = _with_components(members, links)
        if members.isEmpty():
            break
    else:
        links = links.union(landed(_contested_links(members, texts, p), "contested"))
    found = components(links).withColumnRenamed("component", "component_id")
    joined = landed(classes.join(found, "id", "left")
                    .select("set_a", "set_b", "copies", "id", F.coalesce("component_id", "id").alias("component_id"))
                    .filter("copies > 1 or component_id <> id")
                    .select("set_a", "set_b", "component_id"), "classes")
    return (rows.select("doc_id", "n_shingles", "set_a", "set_b").join(joined, ["set_a", "set_b"], "left")
            .select("doc_id", "n_shingles", "set_a", "set_b",
                    F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
                    .alias("component_id"))
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id"))))


def near_duplicates(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text, ...)``.

    Null or empty texts have no shingles and link with nothing.  A row without doc_id is in
    no component (null) and kept.  Rows that repeat a doc_id are one node, whatever their
    texts: what one of them reaches, all do.  Other columns are not read.  An empty table
    gives an empty result.
    """
    rows = _grouped(docs, p)
    torn = landed(rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min("component_id").alias("_lo"), F.max("component_id").alias("_hi"))
                  .filter("_lo < _hi").select("doc_id", "_lo"), "torn")
    if not torn.isEmpty():
        links = rows.join(torn, "doc_id").select(F.col("component_id").alias("a"), F.col("_lo").alias("b"))
        whole = components(links).select(F.col("id").alias("component_id"), F.col("component").alias("_whole"))
        rows = rows.join(whole, "component_id", "left").withColumn("component_id", F.coalesce("_whole", "component_id"))
    return rows.select("doc_id", "n_shingles", "component_id",
                       (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))).alias("kept"))


def dedup(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of ``docs``, all columns: one of each group of near-duplicate texts stays.

    Groups are of texts, not of ids: rows whose id is null or repeated stand for themselves,
    named by a hash of id and text that follows all given ids, so a text whose id has another,
    removed text stays.  Of such rows with equal id and text the one with the smallest hash
    stays.  Rows without words all stay.  User columns may have any names; an empty table gives
    an empty result.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("_id"))
    repeated = landed(ids.groupBy("_id").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1 or _id is null").select("_id"), "repeated")
    if repeated.isEmpty():
        gone = landed(_grouped(docs, p).filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone")), "gone")
        return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"),
                       F.col("text").cast("string").alias("text"))
    rows = rows.join(repeated, F.col("id") == F.col("_id"), "left").withColumn("odd", F.col("id").isNull() | F.col("_id").isNotNull())
    name = F.xxhash64("id", "text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    rows = rows.select("row", "text", "odd", F.when(F.col("odd"), name).otherwise(F.col("id")).alias("name"))
    gone = landed(_grouped(rows.select(F.col("name").alias("doc_id"), "text"), p).filter("doc_id <> component_id")
                  .select(F.col("doc_id").alias("name")).distinct(), "gone")
    left = rows.join(gone, "name", "left_anti").withColumn("odd", F.col("odd") & F.coalesce(is_word_text(F.col("text")), F.lit(False)))
    one = left.filter("odd").groupBy("name").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return left.filter("not odd").select("row.*").unionByName(one.select("row.*"))
