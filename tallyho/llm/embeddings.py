"""Embedding near-duplicates by Euclidean p-stable hashing and exact cosines.

Vectors are normalised; at unit length a cosine of 0.98 is a distance of 0.2.  In each table a
vector's bucket is the tuple of its quantised projections on random Gaussian directions.
Vectors that share a bucket in any table are compared exactly, in blocks: a large bucket is
cut into blocks and each pair of blocks is one group, so neither a group's memory nor a
task's rows grow with the bucket, and pairs are counted where they are found, not emitted.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, landed
from .components import components


@dataclass(frozen=True)
class Params:
    """Link at ``cosine`` or more; ``tables`` of ``projections`` each, quantised to ``width``.

    At distance 0.2 one projection agrees with probability 0.867, a table's twelve with 0.18,
    and no table of 64 does once in 330,000 times.  Unrelated vectors (distance about 1.4)
    share a table's bucket once in 800,000 times.  ``block`` vectors are compared at once.
    """

    cosine: float = 0.98
    tables: int = 64
    projections: int = 12
    width: float = 1.2
    block: int = 1024
    seed: int = 9


@lru_cache(maxsize=4)
def _directions(dims: int, p: Params) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([p.seed, dims])
    n = p.tables * p.projections
    return rng.standard_normal((dims, n)), rng.uniform(0, p.width, n)


def normalised(vectors: list) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of lists of equal length in double precision, and which of them can be compared."""
    x = np.array(vectors, np.float64)
    with np.errstate(all="ignore"):
        scale = np.abs(x).max(axis=1, keepdims=True)
        x = x / scale
        x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x, np.isfinite(x).all(axis=1)


def _hasher(p: Params):
    mult = np.random.default_rng(p.seed).integers(1, 1 << 62, p.projections, dtype=np.uint64) | np.uint64(1)

    def run(rows):
        for batch in batches(rows):
            vectors, labels = batch.column("embedding").to_pylist(), batch.column("label").to_pylist()
            ids = batch.column("vec_id").to_pylist()
            by_length: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                if v and None not in v and labels[i] is not None and ids[i] is not None:
                    by_length.setdefault(len(v), []).append(i)
            out, fine = [], set()
            for dims, at in by_length.items():
                x, ok = normalised([vectors[i] for i in at])
                a, b = _directions(dims, p)
                with np.errstate(all="ignore"):
                    cells = np.floor((np.where(ok[:, None], x, 0) @ a + b) / p.width).astype(np.int64).view(np.uint64)
                keys = np.zeros((len(at), p.tables), np.uint64)
                for j in range(p.projections):
                    keys = (keys ^ cells[:, j::p.projections]) * mult[j]
                    keys ^= keys >> np.uint64(29)
                # tables and lengths don't mix
                keys = (keys + np.arange(p.tables, dtype=np.uint64) + np.uint64(dims << 32)) * np.uint64(0x9E3779B97F4A7C15)
                raw = np.array([vectors[i] for i in at], np.float64) + 0.0  # -0.0 and 0.0 are one value
                out += [(i, xxhash.xxh3_128_digest(raw[n].tobytes()), raw[n], keys[n].view(np.int64))
                        for n, i in enumerate(at) if ok[n]]
                fine.update(i for n, i in enumerate(at) if ok[n])
            # rows that cannot be compared have no code
            out += [(i, None, None, None) for i in range(len(ids)) if i not in fine]
            halves = [np.frombuffer(o[1], np.int64).tolist() if o[1] else (None, None) for o in out]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[o[0]] for o in out], pa.int64()), pa.array([labels[o[0]] for o in out], pa.string()),
                 pa.array([h[0] for h in halves], pa.int64()), pa.array([h[1] for h in halves], pa.int64()),
                 pa.array([o[2] for o in out], pa.list_(pa.float64())), pa.array([o[3] for o in out], pa.list_(pa.int64()))],
                names=["vec_id", "label", "code_a", "code_b", "vector", "keys"])
    return run


def _links(ids, codes, copies, own, x, keys, nth: int, within: bool, p: Params):
    """Links of one group, between its two blocks or within its one block.

    Per vector that has any: id, code, copies linked, smallest id of its component in the group.
    """
    left = np.flatnonzero(own)
    right = left if within else np.flatnonzero(~own)
    near = (x[left] @ x[right].T) >= p.cosine
    if within:
        np.fill_diagonal(near, False)
    i, j = np.nonzero(near)
    i, j = left[i], right[j]
    # a pair counts in the first table in which both share a bucket
    new = ~(keys[i, :nth] == keys[j, :nth]).any(axis=1)
    links = np.bincount(i[new], weights=copies[j[new]], minlength=len(ids))
    if not within:
        links += np.bincount(j[new], weights=copies[i[new]], minlength=len(ids))
    least = ids.copy()
    while len(i):
        before = least.copy()
        np.minimum.at(least, i, before[j])
        np.minimum.at(least, j, before[i])
        if (least == before).all():
            break
    told = (links > 0) | (least != ids)
    return ids[told], codes[told], links[told].astype(np.int64), least[told]


def _lists(column, dtype) -> np.ndarray:
    """A matrix from a list column whose rows have one length."""
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype).reshape(len(column), -1)


def _comparer(p: Params):
    """Links of groups that follow each other; only the last, unfinished group waits for the next batch."""
    def run(rows):
        def told(table):
            """Links of whole groups; vectors of one length at a time, as groups don't mix lengths."""
            lengths = np.diff(table.column("vector").combine_chunks().offsets.to_numpy())
            parts = [alike(table.filter(pa.array(lengths == n))) for n in np.unique(lengths)]
            return pa.RecordBatch.from_arrays([pa.concat_arrays([q.column(c) for q in parts]) for c in range(4)],
                                              names=["id", "code_a", "links", "to"])

        def alike(table):
            place = [table.column(c).to_numpy() for c in ("nth", "key", "lo", "hi", "label_hash")]
            cuts = np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in place], axis=0), True])
            ids, copies, codes = (table.column(c).to_numpy() for c in ("id", "copies", "code_a"))
            own = table.column("own").to_numpy(zero_copy_only=False)
            x, _ = normalised(_lists(table.column("vector").combine_chunks(), np.float64))
            keys = _lists(table.column("keys").combine_chunks(), np.int64)
            out = [_links(ids[a:b], codes[a:b], copies[a:b], own[a:b], x[a:b], keys[a:b], int(place[0][a]),
                          place[2][a] == place[3][a], p)
                   for a, b in zip(cuts[:-1], cuts[1:]) if b - a > 1]
            columns = [np.concatenate([o[c] for o in out] or [np.empty(0, np.int64)]) for c in range(4)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "code_a", "links", "to"])

        waiting = None
        for batch in batches(rows):
            table = pa.Table.from_batches([batch]) if waiting is None else pa.concat_tables([waiting, pa.Table.from_batches([batch])])
            changed = np.any([table.column(c).to_numpy() != table.column(c)[-1].as_py() for c in ("nth", "key", "lo", "hi", "label_hash")],
                             axis=0)
            cut = int(np.flatnonzero(changed)[-1]) + 1 if changed.any() else 0
            if cut:
                yield told(table.slice(0, cut))
            waiting = table.slice(cut)
        if waiting is not None:
            yield told(waiting)
    return run


def near_duplicates(vectors: DataFrame, p: Params = Params()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors(vec_id, embedding, label)``.

    Null, empty and zero vectors, vectors with null or non-finite components, and rows without
    label or vec_id link with nothing; neither do vectors of different lengths.  Equal
    vectors of a label are one class that is compared once and counted with its copies.
    Rows that repeat a vec_id are vectors of their own, each with its own links (a repeated
    row counts as another vector), but one node of the components: what any of them reaches,
    all do.  Other columns are not read; an empty table gives an empty result.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), F.col("label").cast("string"))
    hashed = landed(rows.mapInArrow(_hasher(p), "vec_id long, label string, code_a long, code_b long, "
                                    "vector array<double>, keys array<long>"), "hashed")
    code = ["label", "code_a", "code_b"]
    usable = hashed.filter("code_a is not null")
    # the smallest id and half of the code name a class; two classes of one smallest id differ in the code
    classes = landed(usable.groupBy(*code).agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"),
                                               F.min_by(F.struct("vector", "keys"), "vec_id").alias("of"))
                     .select(*code, "id", "copies", "of.vector", "of.keys"), "classes")
    banded = classes.select("id", "code_a", "label", F.posexplode("keys").alias("nth", "key"))
    bucket = ["label", "nth", "key"]
    shared = landed(banded.groupBy(*bucket).agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "buckets")
    blocks = F.ceil(F.col("size") / p.block).cast("int")
    members = (landed(banded.join(shared, bucket), "members")
               .withColumn("_blocks", blocks).withColumn("_block", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
               .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
               .select("id", "code_a", "nth", "key", F.xxhash64("label").alias("label_hash"), F.least("_block", "_other").alias("lo"),
                       F.greatest("_block", "_other").alias("hi"), (F.col("_block") <= F.col("_other")).alias("own")))
    group = ["label_hash", "nth", "key", "lo", "hi"]
    full = members.join(classes.select("id", "code_a", "copies", "vector", "keys"), ["id", "code_a"])
    found = landed(full.repartition(*group).sortWithinPartitions(*group)
                   .mapInArrow(_comparer(p), "id long, code_a long, links long, to long"), "found")
    links = found.groupBy("id", "code_a").agg(F.sum("links").alias("links"))
    # an id in several classes joins them
    held = usable.select("vec_id", *code).join(classes.select(*code, "id"), code)
    torn = landed(held.groupBy("vec_id").agg(F.min("id").alias("_lo"), F.max("id").alias("_hi")).filter("_lo < _hi").select("vec_id", "_lo"), "torn")
    several = held.join(torn, "vec_id").filter("id <> _lo").select(F.col("id").alias("a"), F.col("_lo").alias("b"))
    groups = components(found.filter("id <> to").select(F.col("id").alias("a"), F.col("to").alias("b")).union(several))
    done = landed(classes.select(*code, "id", "copies").join(links, ["id", "code_a"], "left").join(groups, "id", "left")
                  .select(*code, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                          F.coalesce("component", "id").alias("component_id"), F.col("component").isNotNull().alias("_joined"))
                  .filter("n_links > 0 or _joined").drop("_joined"), "classes")
    own = landed(hashed.select("vec_id", *code).join(done, code, "left")
                 .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         F.coalesce("component_id", "vec_id").alias("component_id"), F.col("code_a").isNull().alias("_apart")), "own")
    # a row that cannot be compared is of the component of the other rows of its id
    also = (own.join(own.filter("_apart").select(F.col("vec_id").alias("_id")).distinct(), F.col("vec_id") == F.col("_id"), "left_semi")
            .filter("not _apart").groupBy(F.col("vec_id").alias("_id")).agg(F.min("component_id").alias("_same")))
    return (own.join(also, F.col("vec_id") == F.col("_id"), "left")
            .select("vec_id", "n_links", F.when(F.col("_apart"), F.coalesce("_same", "component_id")).otherwise(F.col("component_id"))
                    .alias("component_id"))
            .withColumn("kept", F.col("vec_id").isNull() | (F.col("vec_id") == F.col("component_id"))))
