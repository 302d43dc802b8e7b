"""Merkle manifest of a dataset: a tree a source over its documents, a tree over the sources' roots, a proof a document.

Leaves are hashed where the documents are read and numbered within their source.  Runs of
``arity`` nodes are hashed into their parent.  A superblock, the leaves below one node some
levels up, is reduced in one task; the few nodes above superblocks are reduced level by
level.  In the end each superblock's leaves meet the nodes its proofs need above it (one row
of runs, ``arity`` digests a level) in a cogroup, which finishes the local reduction, joins
the proofs and folds them with the leaves of another copy.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import global_index, occurrence_number
from .common import landed

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass(frozen=True)
class Params:
    """Runs of ``arity`` nodes; a superblock holds ``arity ** levels`` leaves at most."""

    arity: int = 16
    levels: int = 3

    @property
    def block(self) -> int:
        return self.arity ** self.levels


def digest(columns: list[Column]) -> Column:
    """SHA-256, as hex, of values that are each ``-`` if null, else UTF-8 length, ``:`` and the value."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
                             for t in texts]), 256)


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _depth(n: int, p: Params) -> int:
    """Levels of a superblock's own tree: those that ``n`` leaves of a source need, ``levels`` at most."""
    depth = 0
    while depth < p.levels and p.arity ** depth < n:
        depth += 1
    return depth


def _reduce(leaves: list[str], depth: int, p: Params) -> list[list[str]]:
    """The nodes of each level, leaves first."""
    out = [leaves]
    for _ in range(depth):
        below = out[-1]
        out.append([_hash("".join(below[i:i + p.arity])) for i in range(0, len(below), p.arity)])
    return out


def _without(run: str, slot: int) -> str:
    return run[:64 * slot] + run[64 * (slot + 1):]


def _replaced(run: str, slot: int, node: str) -> str:
    return _hash(run[:64 * slot] + node + run[64 * (slot + 1):])


def _hexed(column: pd.Series) -> list[str]:
    return [bytes(b).hex() for b in column]


def _block_root(p: Params):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        n = int(pdf["n"].iat[0])
        top = _reduce(_hexed(pdf["leaf"]), _depth(n, p), p)[-1][0]
        return pd.DataFrame({"tree": [key[0]], "idx": [key[1]], "m": [-(-n // p.block)], "node": [top]})
    return run


def _prover(p: Params):
    def run(key: tuple, pdf: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        levels = _reduce(_hexed(pdf["leaf"]), _depth(int(pdf["n"].iat[0]), p), p)
        above = [(int(step["slot"]), step["run"]) for step in outer["path"].iat[0]]
        tail = "".join(_without(r, slot) for slot, r in above).encode()
        runs = [["".join(nodes[i:i + p.arity]) for i in range(0, len(nodes), p.arity)] for nodes in levels[:-1]]
        proofs, folded = [], []
        for at, node in enumerate(_hexed(pdf["copy"])):
            proof, place = sha256(), at
            for level in runs:
                place, slot = divmod(place, p.arity)
                proof.update(_without(level[place], slot).encode())
                node = _replaced(level[place], slot, node)
            for slot, r in above:
                node = _replaced(r, slot, node)
            proof.update(tail)
            proofs.append(proof.hexdigest())
            folded.append(node)
        subroot, root = outer["subroot"].iat[0], outer["root"].iat[0]
        return pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64").array, "leaf": levels[0], "subroot": subroot, "root": root,
                             "proof_sha256": proofs, "folded_root": folded, "verified": [f == root for f in folded]})
    return run


def _climb(nodes: DataFrame, p: Params) -> tuple[DataFrame, DataFrame]:
    """From ``nodes(tree, idx, m, node)``, ``m`` nodes a tree: each node's way up as ``path``, and each tree's root.

    A path holds a run a level, from the node's own up: its nodes' digests one after another
    and the slot of the way in it.  Each level is a table a sixteenth of the last.
    """
    level, runs, roots = nodes, [], []
    while True:
        roots.append(level.filter("m = 1").select("tree", F.col("node").alias("root")))
        open_ = level.filter("m > 1")
        if open_.isEmpty():
            break
        members = F.array_sort(F.collect_list(F.struct("idx", "node")))  # at most arity
        run = landed(open_.groupBy("tree", F.floor(F.col("idx") / p.arity).alias("up"), "m").agg(members.alias("s"))
                     .select("tree", "up", "m", F.array_join("s.node", "").alias("run")), "runs")
        runs.append(run.select("tree", "up", "run"))
        level = landed(run.select("tree", F.col("up").alias("idx"), F.ceil(F.col("m") / p.arity).alias("m"),
                                  F.sha2("run", 256).alias("node")), "level")
    paths = nodes.select("tree", "idx", F.array().cast("array<struct<slot:int,run:string>>").alias("path"))
    for k, run in enumerate(runs):
        below = F.floor(F.col("idx") / p.arity ** k)
        step = F.struct(F.pmod(below, F.lit(p.arity)).cast("int").alias("slot"), F.col("run"))
        above = run.select(F.col("tree").alias("_tree"), F.col("up").alias("_up"), "run")
        paths = (paths.join(above, (F.col("tree") == F.col("_tree")) & (F.floor(below / p.arity) == F.col("_up")), "left")
                 .select("tree", "idx", F.when(F.col("run").isNull(), F.col("path")).otherwise(F.array_append("path", step)).alias("path")))
    root = roots[0]
    for more in roots[1:]:
        root = root.union(more)
    return landed(paths, "paths"), landed(root, "roots")


def manifest(docs: DataFrame, other: dict[str, Column] | None = None, p: Params = Params()) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row of ``docs``.

    ``other`` gives columns of another copy's rows as expressions over this copy's (none: the
    same); its leaves are folded with this copy's proofs, and ``verified`` tells whether that
    gives the root.  Null values are told from empty ones; null sources are one source, the
    first; rows without doc_id come first in theirs.  Rows that repeat an id follow each other
    by digest; which of two equal rows has which place cannot be told.  Further columns are
    not read; an empty table gives an empty result.
    """
    mine = {c: F.col(f"`{c}`") for c in COLUMNS}
    theirs = {**mine, **(other or {})}
    leaves = landed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                                F.unhex(digest(list(mine.values()))).alias("leaf"),
                                F.unhex(digest([theirs[c] for c in COLUMNS])).alias("copy")), "leaves")
    placed = landed(occurrence_number(leaves, ["source"], ["doc_id", "leaf"], "pos"), "placed")
    sizes = landed(placed.groupBy("source").agg(F.count(F.lit(1)).alias("n")), "sizes")
    trees = landed(global_index(sizes, ["source"], "tree").select("tree", "n", F.col("source").alias("_of")), "trees")
    rows = (placed.join(trees, F.col("source").eqNullSafe(F.col("_of"))).withColumn("pos", F.col("pos") - 1)
            .select("tree", F.floor(F.col("pos") / p.block).alias("idx"), "pos", "n", "doc_id", "leaf", "copy"))
    blocks = landed(rows.select("tree", "idx", "pos", "n", "leaf").groupBy("tree", "idx")
                    .applyInPandas(_block_root(p), "tree long, idx long, m long, node string"), "blocks")
    paths, subroots = _climb(blocks, p)
    many = subroots.count()
    tops, root = _climb(subroots.select(F.lit(0).alias("tree"), (F.col("tree") - 1).alias("idx"), F.lit(many).alias("m"),
                                        F.col("root").alias("node")), p)
    above = tops.select((F.col("idx") + 1).alias("tree"), F.col("path").alias("_top"))
    outer = (paths.join(above, "tree").join(subroots.withColumnRenamed("root", "subroot"), "tree")
             .join(F.broadcast(root.select("root")), how="inner", on=F.lit(True))  # one row
             .select("tree", "idx", F.concat("path", "_top").alias("path"), "subroot", "root"))
    return rows.groupBy("tree", "idx").cogroup(outer.groupBy("tree", "idx")).applyInPandas(
        _prover(p), "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
