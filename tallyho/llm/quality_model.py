"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Each text becomes a short vector of statistics; random cosines of it approximate a Gaussian
kernel.  The ridge scores come from normal equations that are summed over partitions;
a monotone map fitted on documents that the regression did not see turns them into
probabilities.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, landed


@dataclass(frozen=True)
class Params:
    """``features`` random cosines at ``gamma`` after standardising; ridge ``penalty`` a row.

    Fitted on a hash-chosen sample of about ``sample`` labelled rows (all where there are fewer);
    a third of them calibrate in ``bins`` equal steps of the raw score.
    """

    features: int = 256
    gamma: float = 0.02
    penalty: float = 1e-4
    sample: int = 200_000
    bins: int = 200
    seed: int = 5


STATISTICS = ("log_words", "word_length", "word_spread", "upper", "digits", "punctuation", "symbols", "non_ascii", "exclaimed",
              "piped", "repeats", "distinct", "dup_lines", "line_words", "sentences", "alone", "top_word", "capitals")
_ALONE = re.compile(rb"^[^A-Za-z0-9\x80-\xff]+$")
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_PUNCTUATION = b".,;:!?'\"()-"
_SYMBOLS = b"#*$%&|<>@^~_=+/\\{}[]"
_HIGH = bytes(range(0x80, 0x100))


def statistics(text: str | None) -> list[float]:
    """The STATISTICS of a whole text; all 0 without a word."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    chars = sum(map(len, words))
    def share(of: bytes) -> float:
        return (len(raw) - len(raw.translate(None, of))) / chars
    lengths = np.fromiter(map(len, words), np.float64, n)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    counts = Counter(words)
    repeats = sum(map(bytes.__eq__, words[1:], words[:-1]))
    return [np.log1p(n), chars / n, float(lengths.std()), share(_UPPER), share(_DIGITS), share(_PUNCTUATION), share(_SYMBOLS),
            share(_HIGH), raw.count(b"!") / n, raw.count(b"|") / n, repeats / n, len(counts) / n ** 0.8,
            1 - len(set(lines)) / len(lines), float(np.log1p(n / len(lines))), raw.count(b".") / n,
            sum(1 for w in words if not w.isalnum() and _ALONE.match(w)) / n, max(counts.values()) / n,
            sum(map(bytes.isupper, words)) / n]


def _measurer(rows):
    for batch in batches(rows):
        values = [statistics(t.as_py()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.list_(pa.float64()))],
                                         names=["doc_id", "stats"])


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, stats`` of every whole text."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _measurer, "doc_id long, stats array<double>")


@dataclass(frozen=True)
class Model:
    """Weights of the cosines, and the calibration as ascending steps."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    offsets: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    chances: np.ndarray

    def cosines(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        return np.c_[np.sqrt(2 / len(self.offsets)) * np.cos(z @ self.directions + self.offsets), np.ones(len(z))]

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.cosines(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.steps):
            return np.full(len(stats), self.chances[0])
        return np.clip(np.interp(self.raw(stats), self.steps, self.chances), 0, 1)


def _stats(batch) -> np.ndarray:
    return np.array(batch.column("stats").to_pylist(), np.float64).reshape(-1, len(STATISTICS))


def _moments(rows):
    """Count, sums and sums of squares of a partition, as one row."""
    total = np.zeros((2, len(STATISTICS)))
    n = 0
    for batch in batches(rows):
        x = _stats(batch)
        n += len(x)
        total += [x.sum(axis=0), (x * x).sum(axis=0)]
    yield pa.RecordBatch.from_pydict({"at": list(range(3)), "sums": [[float(n)] * len(STATISTICS), *total.tolist()]},
                                     schema=_SUMS)


_SUMS = pa.schema([("at", pa.int32()), ("sums", pa.list_(pa.float64()))])


def _normal_equations(model):
    def run(rows):
        """A partition's share of X'X and X'y, one row for each row of the matrix."""
        m = model.value
        size = len(m.offsets) + 1
        total = np.zeros((size, size + 1))
        for batch in batches(rows):
            x = m.cosines(_stats(batch))
            total += x.T @ np.c_[x, batch.column("label").to_numpy().astype(np.float64)]
        yield pa.RecordBatch.from_pydict({"at": list(range(size)), "sums": total.tolist()}, schema=_SUMS)
    return run


def _added(table: pa.Table) -> pa.Table:
    return pa.Table.from_pydict({"at": table.column("at")[:1].to_pylist(),
                                 "sums": [np.array(table.column("sums").to_pylist()).sum(axis=0).tolist()]}, schema=_SUMS)


def _summed(parts: DataFrame) -> np.ndarray:
    """The sum over partitions; the driver gets one row for each row of a matrix of fixed size."""
    rows = parts.groupBy("at").applyInArrow(_added, "at int, sums array<double>").collect()
    return np.array([r["sums"] for r in sorted(rows, key=lambda r: r["at"])])


def _raw_scores(model):
    def run(rows):
        for batch in batches(rows):
            yield pa.RecordBatch.from_arrays([pa.array(model.value.raw(_stats(batch))), batch.column("label")], names=["raw", "label"])
    return run


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence of least weighted squared distance (pool adjacent violators)."""
    pools: list[list[float]] = []
    for v, w in zip(values, weights):
        pools.append([v * w, w, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s, w, n = pools.pop()
            pools[-1][0] += s
            pools[-1][1] += w
            pools[-1][2] += n
    return np.concatenate([[s / w] * n for s, w, n in pools]) if pools else np.empty(0)


def fit(labelled: DataFrame, p: Params = Params()) -> Model:
    """A model from ``labelled(doc_id, stats, label 0 or 1)``; without rows, one that says 0.5."""
    spark = labelled.sparkSession
    n = labelled.count()
    chance = min(1.0, p.sample / max(1, n))
    rows = landed(labelled.filter(F.pmod(F.xxhash64("doc_id", F.lit(p.seed)), F.lit(1 << 20)) < int(chance * (1 << 20)))
                  .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(p.seed + 1)), F.lit(3))), "sample")
    rng = np.random.default_rng(p.seed)
    sums = _summed(rows.select("stats").mapInArrow(_moments, "at int, sums array<double>"))
    if n == 0 or not len(sums) or sums[0][0] == 0:
        empty = np.empty(0)
        return Model(empty, empty, empty, empty, empty, empty, np.array([0.5]))
    mean = sums[1] / sums[0]
    scale = np.sqrt(np.maximum(sums[2] / sums[0] - mean ** 2, 1e-12))
    k = p.features
    bare = Model(mean, scale, rng.standard_normal((len(STATISTICS), k)) * np.sqrt(2 * p.gamma), rng.uniform(0, 2 * np.pi, k),
                 np.zeros(k + 1), np.empty(0), np.empty(0))
    equations = _summed(rows.filter("part <> 0").select("stats", "label")
                        .mapInArrow(_normal_equations(spark.sparkContext.broadcast(bare)), "at int, sums array<double>"))
    ridge = equations[:, :-1] + np.eye(k + 1) * p.penalty * max(1.0, equations[-1, -2])
    model = Model(mean, scale, bare.directions, bare.offsets, np.linalg.solve(ridge, equations[:, -1]), np.empty(0), np.empty(0))
    width = 2.0 / p.bins  # raw scores lie around 0 to 1; beyond -0.5 and 1.5 the first and last bin hold
    bin_ = F.least(F.greatest(F.floor((F.col("raw") + 0.5) / width), F.lit(0)), F.lit(p.bins - 1))
    by_bin = (rows.filter("part = 0").select("stats", "label")
              .mapInArrow(_raw_scores(spark.sparkContext.broadcast(model)), "raw double, label int")
              .groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("share"),
                                              F.avg("raw").alias("raw")).orderBy("bin").collect())
    if not by_bin:
        return Model(mean, scale, bare.directions, bare.offsets, model.weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    chances = isotonic(np.array([r["share"] for r in by_bin]), np.array([float(r["n"]) for r in by_bin]))
    return Model(mean, scale, bare.directions, bare.offsets, model.weights, np.array([r["raw"] for r in by_bin]), chances)


def _scorer(model):
    def run(rows):
        for batch in batches(rows):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.value.score(_stats(batch)))],
                                             names=["doc_id", "score"])
    return run


def held_out(column: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text is 1 modulo 3 (null: no)."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document, learnt from ``labels(doc_id, quality)``.

    Labels other than 0 and 1, and of held-out or null ids, teach nothing; of several for a
    document each counts.  Null and empty texts have all statistics 0 and get the score of
    such a vector.  Without any label every score is 0.5.  Other columns are not read; an
    empty table gives an empty result.
    """
    stats = landed(measured(docs), "statistics")
    known = (labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("label"))
             .filter("label in (0, 1)").filter(~held_out()))
    model = fit(stats.join(known, "doc_id"), p)
    scored = stats.mapInArrow(_scorer(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
