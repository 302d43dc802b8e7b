"""WARC records and a Merkle fixity audit of replicas.

Records lie one after the other in an archive.  Leaves are SHA-256 digests of whole records
with their offset ranges; each node above is the digest of up to ``fanout`` following nodes
and the range they span; the root stands for the archive.  Replicas are compared from the
roots down, and only below nodes that differ.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import landed

CRLF = "\r\n"


@dataclass(frozen=True)
class Params:
    """``fanout`` children a node; ``archive`` consecutive record ids make an archive."""

    fanout: int = 16
    archive: int = 4096


def record(url: Column, html: Column) -> Column:
    """The bytes of a response record: header lines, an empty line, the payload, two line ends."""
    body = F.coalesce(html.cast("string"), F.lit("")).cast("binary")
    head = F.concat(F.lit(f"WARC/1.0{CRLF}WARC-Type: response{CRLF}WARC-Target-URI: "),
                    F.regexp_replace(F.coalesce(url.cast("string"), F.lit("")), "[\\r\\n]", " "),
                    F.lit(f"{CRLF}WARC-Payload-Digest: sha256:"), F.sha2(body, 256),
                    F.lit(f"{CRLF}Content-Type: text/html{CRLF}Content-Length: "), F.octet_length(body).cast("string"),
                    F.lit(CRLF + CRLF))
    return F.concat(head.cast("binary"), body, F.lit(CRLF + CRLF).cast("binary"))


def payload(record_: Column) -> Column:
    """What follows the header lines of a record, without the two line ends."""
    text = record_.cast("string")
    start = F.instr(text, CRLF + CRLF) + 4
    return F.substring(text, start, F.length(text) - start - 3)


def records(pages: DataFrame, p: Params = Params()) -> DataFrame:
    """``archive, page_id, record`` of pages (page_id, url, html).

    Archives take ``p.archive`` consecutive page ids, so an archive is bounded where ids are
    distinct.  Pages without an id go to archive -1; null urls and texts are empty.
    """
    return pages.select(F.coalesce(F.floor(F.col("page_id") / p.archive), F.lit(-1)).cast("long").alias("archive"), "page_id",
                        record(F.col("url"), F.col("html")).alias("record"))


def index(rows: DataFrame) -> DataFrame:
    """``archive, nth, page_id, from, bytes, hash``: where each record lies, and its digest.

    Inside an archive records are ordered by id, then by digest.  Only sizes and digests are
    shuffled, never records.
    """
    rows = rows.select("archive", "page_id", F.octet_length("record").cast("long").alias("bytes"), F.sha2("record", 256).alias("hash"))
    order = Window.partitionBy("archive").orderBy(F.col("page_id").asc_nulls_first(), "hash")
    return rows.select("archive", (F.row_number().over(order) - 1).cast("long").alias("nth"), "page_id",
                       (F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("bytes")).alias("from"),
                       "bytes", "hash")


def leaves(indexed: DataFrame) -> DataFrame:
    """Level 0 of the trees: ``archive, nth, from, upto, hash`` of each record."""
    return indexed.select("archive", "nth", "from", (F.col("from") + F.col("bytes")).alias("upto"), "hash")


def _above(nodes: DataFrame, p: Params) -> DataFrame:
    child = F.struct("nth", F.concat_ws(":", "from", "upto", "hash").alias("said"))
    return (nodes.groupBy("archive", F.floor(F.col("nth") / p.fanout).alias("nth"))
            .agg(F.min("from").alias("from"), F.max("upto").alias("upto"), F.sort_array(F.collect_list(child)).alias("_c"))
            .select("archive", "nth", "from", "upto",
                    F.sha2(F.array_join(F.transform("_c", lambda c: c["said"]), "\n").cast("binary"), 256).alias("hash")))


def trees(indexed: DataFrame, p: Params = Params()) -> list[DataFrame]:
    """The levels of every archive's tree, from leaves to roots, each written once."""
    levels = [landed(leaves(indexed), "leaves")]
    while not levels[-1].filter("nth > 0").isEmpty():
        levels.append(landed(_above(levels[-1], p), "level"))
    return levels


def audit(left: DataFrame, right: DataFrame, p: Params = Params()) -> DataFrame:
    """Records that differ between two replicas: ``archive, nth, left_hash, right_hash``.

    Takes indexes as from ``index``; a hash is null where a replica has no such record.  From
    the roots down, a level's nodes are compared only below parents that differ; an archive
    of which a replica is higher is followed from there.  Empty replicas have no trees.
    """
    a, b = trees(left, p), trees(right, p)
    top = max(len(a), len(b))
    below = None
    for level in range(top - 1, -1, -1):
        sides = []
        for side, tree in (("left", a), ("right", b)):
            nodes = tree[level] if level < len(tree) else tree[0].limit(0)
            nodes = nodes.select("archive", "nth", F.concat_ws(":", "from", "upto", "hash").alias(side), F.col("hash").alias(f"{side}_hash"))
            if below is not None:
                nodes = (nodes.withColumn("_parent", F.floor(F.col("nth") / p.fanout))
                         .join(below.select("archive", F.col("nth").alias("_parent")), ["archive", "_parent"], "left_semi"))
            sides.append(nodes)
        differ = sides[0].join(sides[1], ["archive", "nth"], "full").filter(~F.col("left").eqNullSafe(F.col("right")))
        below = landed(differ.select("archive", "nth", "left_hash", "right_hash"), "differ")
    return below


def located(differing: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """What an audit found, with page ids, offset ranges and kind of fault.

    A record lost or gained shifts all that follow it, so records at differing places are
    matched again inside their archive: first those of equal id and digest, then what is
    left of equal id, each in order.  `missing` and `added` are records that only one replica
    has, `moved` ones whose bytes agree at another offset, `corrupt` ones whose bytes differ.
    Places are the left replica's, the right one's for `added`.
    """
    def side(indexed, name):
        found = differing.filter(F.col(f"{name}_hash").isNotNull()).select("archive", "nth")
        found = found.join(indexed.select("archive", "nth", "page_id", "from", "bytes", "hash"), ["archive", "nth"])
        return landed(_numbered(found, ["archive", "page_id", "hash"]), name)

    def matched(a, b, *keys):
        a, b = a.alias("a"), b.alias("b")
        on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in ("archive", "page_id", *keys, "occ")]
        both = a.join(b, reduce(Column.__and__, on), "full")
        return landed(both.select(*[F.col(f"{x}.{c}").alias(f"{x}_{c}") for x in "ab" for c in
                                    ("archive", "nth", "page_id", "from", "bytes", "hash")]), "matched")

    def rest(pairs, x, other):
        one = pairs.filter(F.col(f"{other}_nth").isNull())
        one = one.select(*[F.col(f"{x}_{c}").alias(c) for c in ("archive", "nth", "page_id", "from", "bytes", "hash")])
        return landed(_numbered(one, ["archive", "page_id"]), "rest")

    same = matched(side(left, "left"), side(right, "right"), "hash")
    # equal bytes at the same offset are no fault, whatever the number of records before them
    moved = same.filter("a_nth is not null and b_nth is not null and a_from <> b_from").withColumn("kind", F.lit("moved"))
    other = matched(rest(same, "a", "b"), rest(same, "b", "a"))
    other = other.withColumn("kind", F.when(F.col("b_nth").isNull(), "missing").when(F.col("a_nth").isNull(), "added").otherwise("corrupt"))
    rows = moved.unionByName(other)
    is_left = F.col("a_nth").isNotNull()
    return rows.select(*[F.when(is_left, F.col(f"a_{c}")).otherwise(F.col(f"b_{c}")).alias(c)
                         for c in ("archive", "nth", "page_id", "from", "bytes")], "kind")


def _numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``occ``: the number of a row among those of equal keys, in the order of the archive."""
    return rows.withColumn("occ", F.row_number().over(Window.partitionBy(*keys).orderBy("nth")))
