"""Embedding whitening from the exact characteristic polynomial of the integer scatter.

Components of vectors become integers, so sums and products over all vectors are exact and
do not depend on an order.  The scatter's characteristic polynomial is found modulo many
primes (Hessenberg form, one prime a row of a Spark table) and put together by Chinese
remaindering.  All its roots are real, so Descartes' sign changes count the roots above a
point exactly; bisection isolates them, and each root's component comes from inverse iteration on
the matrix less the root, in long integers.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction
from math import comb, isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches

LIMBS = 5          # 32-bit limbs of a sum; the last one carries the sign
LARGEST = 2.0**56  # entries beyond this (times ``scale``) have no exact integer here


@dataclass(frozen=True)
class Params:
    """``scale`` makes integers of entries; ``components`` at most; ``digits`` (bits) of roots and vectors.

    The polynomial's work on the driver grows with the vectors' length, not with the rows.
    """

    scale: int = 64
    components: int = 32
    digits: int = 192


def _matrix(column: pa.Array, p: Params) -> np.ndarray:
    """Integers of a batch's vectors, all of one length."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(values * p.scale).astype(np.int64).reshape(len(column), -1)


def _cells(dims: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(dims)


def _limbs(values: list[int]) -> np.ndarray:
    out = np.empty((len(values), LIMBS), np.int64)
    for i, v in enumerate(values):
        for k in range(LIMBS - 1):
            out[i, k] = v & 0xFFFFFFFF
            v >>= 32
        out[i, -1] = v
    return out


def _products(y: np.ndarray) -> np.ndarray:
    """y.T @ y without rounding: in doubles where they are exact, else in Python's integers."""
    most = int(np.abs(y).max(initial=0))
    if most * most * len(y) < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    o = y.astype(object)
    return o.T @ o


def _summer(dims: int, p: Params):
    """Sums of the entries and of their products, one partition's, in limbs."""
    def run(rows):
        first, second, n = np.zeros(dims, object), np.zeros((dims, dims), object), 0
        for batch in batches(rows):
            y = _matrix(batch.column("embedding"), p)
            n += len(y)
            first += y.sum(axis=0, dtype=object) if np.abs(y).max() > 1 << 40 else y.sum(axis=0).astype(object)
            second += _products(y)
        if n:
            limbs = _limbs([int(v) for v in [*first, *second[_cells(dims)]]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(limbs))), *[pa.array(np.ascontiguousarray(limbs[:, k])) for k in range(LIMBS)]],
                                             names=["cell", *[f"l{k}" for k in range(LIMBS)]])
    return run


def sums(rows: DataFrame, dims: int, p: Params) -> tuple[list[int], np.ndarray]:
    """Sums of the entries and of the products of ``rows(embedding)``; one row a cell comes to the driver."""
    names = [f"l{k}" for k in range(LIMBS)]
    found = (rows.select("embedding").mapInArrow(_summer(dims, p), "cell long, " + ", ".join(f"{c} long" for c in names))
             .groupBy("cell").agg(*[F.sum(c).alias(c) for c in names]).collect())
    values = [0] * (dims + dims * (dims + 1) // 2)
    for r in found:
        values[r["cell"]] = sum(r[c] << (32 * k) for k, c in enumerate(names))
    second = np.zeros((dims, dims), object)
    second[_cells(dims)] = values[dims:]
    return values[:dims], second + np.triu(second, 1).T


def primes(count: int) -> list[int]:
    """The largest primes below 2^31; products of two residues fit in 63 bits."""
    def is_prime(n: int) -> bool:
        odd, twos = n - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):
            x = pow(base, odd, n)
            if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
                return False
        return True
    out, n = [], (1 << 31) - 1
    while len(out) < count:
        if is_prime(n):
            out.append(n)
        n -= 2
    return out


def polynomial_mod(matrix: np.ndarray, prime: int) -> np.ndarray:
    """Coefficients, constant first, of det(x - matrix) modulo a prime, by way of the Hessenberg form."""
    d = len(matrix)
    h = (matrix % prime).astype(np.int64)
    for m in range(1, d - 1):
        nonzero = np.flatnonzero(h[m:, m - 1])
        if not len(nonzero):
            continue
        i = m + nonzero[0]
        h[[i, m]] = h[[m, i]]
        h[:, [i, m]] = h[:, [m, i]]
        u = h[m + 1:, m - 1] * pow(int(h[m, m - 1]), -1, prime) % prime
        h[m + 1:] = (h[m + 1:] - u[:, None] * h[m] % prime) % prime
        h[:, m] = (h[:, m] + (h[:, m + 1:] * u % prime).sum(axis=1)) % prime
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        polys[k, 1:] = polys[k - 1, :-1]
        polys[k] = (polys[k] - h[k - 1, k - 1] * polys[k - 1] % prime) % prime
        below = 1
        for i in range(1, k):
            below = below * int(h[k - i, k - i - 1]) % prime
            if not below:
                break
            polys[k] = (polys[k] - int(h[k - i - 1, k - 1]) * below % prime * polys[k - i - 1] % prime) % prime
    return polys[d]


def polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Coefficients, constant first, of det(x - matrix) of a positive semidefinite integer matrix.

    Their sizes are elementary symmetric sums of roots that are not negative, so at most those
    of equal roots of the same trace: this bounds how many primes are needed.
    """
    d, trace = len(matrix), int(np.trace(matrix))
    most = max(comb(d, k) * (trace // d + 1) ** k for k in range(d + 1))
    moduli = primes(most.bit_length() // 30 + 2)

    def solve(frames):
        for pdf in frames:
            yield pd.DataFrame({"prime": pdf["prime"], "c": [polynomial_mod(matrix, int(q)).tolist() for q in pdf["prime"]]})
    table = spark.createDataFrame([(q,) for q in moduli], "prime long").repartition(min(len(moduli), spark.sparkContext.defaultParallelism))
    found = {r["prime"]: r["c"] for r in table.mapInPandas(solve, "prime long, c array<long>").collect()}
    out, product = [0] * (d + 1), 1
    for q in moduli:
        inverse = pow(product, -1, q)
        out = [v + product * ((c - v) * inverse % q) for v, c in zip(out, found[q])]
        product *= q
    return [v - product if v > product // 2 else v for v in out]


def _scaled(poly: list[int], t: int) -> list[int]:
    """2^(t d) poly(y / 2^t) as a polynomial in y."""
    d = len(poly) - 1
    return [c << (t * (d - k)) for k, c in enumerate(poly)]


def roots_above(poly: list[int], c: int, t: int) -> int:
    """How many roots of a polynomial with real roots only, repeats counted, are above c / 2^t.

    The sign changes of the polynomial shifted to that point: Descartes' bound, exact here.
    """
    a = _scaled(poly, t)
    d = len(a) - 1
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            a[k] += c * a[k + 1]
    signs = [v > 0 for v in a if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def isolate(poly: list[int], wanted: int, digits: int) -> list[tuple[int, int, int, int, int]]:
    """Intervals ``(first, count, lo, hi, t)`` of the largest roots: ``count`` of them, from the ``first``, in (lo, hi] / 2^t.

    ``count`` is above 1 only for roots that agree in ``digits`` bits, which are taken as equal.
    ``poly`` has positive roots only.
    """
    top = 1 << max(1, max((-(-abs(c).bit_length() // (len(poly) - 1 - k)) + 1) for k, c in enumerate(poly[:-1])) + 1)
    out, stack = [], [(0, top, 0, roots_above(poly, 0, 0), 0)]
    while stack:
        lo, hi, t, n, first = stack.pop()
        if not n or first >= wanted:
            continue
        if n == 1 or (lo and (hi - lo) << digits <= hi):
            out.append((first, n, lo, hi, t))
            continue
        if hi - lo == 1:
            lo, hi, t = lo * 2, hi * 2, t + 1
        mid = (lo + hi) // 2
        above = roots_above(poly, mid, t) - first
        stack += [(lo, mid, t, n - above, first + above), (mid, hi, t, above, first)]
    return sorted(out)


def refine(poly: list[int], lo: int, hi: int, t: int, digits: int) -> tuple[int, int]:
    """The one root in (lo, hi] / 2^t as c / 2^t, to ``digits`` bits, by the sign in the middle."""
    def sign(c, t):
        value = 0
        for k, a in enumerate(reversed(poly)):
            value = value * c + (a << (t * k))
        return (value > 0) - (value < 0)
    end = sign(hi, t)
    while end and (not lo or (hi - lo) << digits > hi):
        if hi - lo == 1:
            lo, hi, t = lo * 2, hi * 2, t + 1
        mid = (lo + hi) // 2
        s = sign(mid, t)
        if not s:
            return mid, t
        lo, hi = (lo, mid) if s == end else (mid, hi)
    return hi, t


def null_space(matrix: np.ndarray, c: int, t: int, count: int, digits: int) -> np.ndarray:
    """``count`` orthonormal vectors that matrix - c / 2^t takes to (nearly) nothing, as rows of doubles.

    Elimination once, then two rounds of inverse iteration, in integers with 2 * ``digits`` bits
    behind the point; a pivot that vanishes is taken as the smallest number there is.
    """
    d, w = len(matrix), 2 * digits
    m = matrix * (1 << t) - np.diag(np.array([c] * d, object))
    shift = w - max(int(abs(v)).bit_length() for v in m.ravel())
    m = m * (1 << shift) if shift >= 0 else m >> -shift
    order, factors = [], []
    for k in range(d):
        i = k + max(range(d - k), key=lambda r: abs(m[k + r, k]))
        m[[i, k]] = m[[k, i]]
        if not m[k, k]:
            m[k, k] = 1
        f = (m[k + 1:, k] << w) // m[k, k]
        m[k + 1:, k:] -= (f[:, None] * m[k, k:]) >> w
        order.append(i)
        factors.append(f)

    def solve(b):
        b = b.copy()
        for k in range(d):
            b[[order[k], k]] = b[[k, order[k]]]
            b[k + 1:] -= (factors[k] * b[k]) >> w
        x = np.zeros(d, object)
        for k in range(d - 1, -1, -1):
            x[k] = ((b[k] << w) - (m[k, k + 1:] * x[k + 1:]).sum()) // m[k, k]
        return x

    def unit(x, others):
        x = x * (1 << w) // max(max(abs(v) for v in x), 1)
        for _ in range(2):
            for o in others:
                x = x - (((x * o).sum() >> w) * o >> w)
            x = x * (1 << w) // max(isqrt(int((x * x).sum())), 1)
        return x

    rng = np.random.default_rng(11)
    found = [np.array([int(v) << (w - 20) for v in rng.integers(-1 << 20, 1 << 20, d)], object) for _ in range(count)]
    for _ in range(2):
        done: list[np.ndarray] = []
        for b in found:
            done.append(unit(solve(b), done))
        found = done
    return np.array([[v / (1 << w) for v in x] for x in found], np.float64)


def components(spark: SparkSession, scatter: np.ndarray, p: Params) -> tuple[list[Fraction], np.ndarray]:
    """The largest roots (not zero) of an integer scatter, falling, and their unit vectors as rows."""
    d = len(scatter)
    poly = polynomial(spark, scatter)
    zeros = next(k for k, c in enumerate(poly) if c)
    poly = poly[zeros:]
    if len(poly) == 1:
        return [], np.zeros((0, d))
    places = isolate(poly, p.components, p.digits)

    def solve(frames):
        for pdf in frames:
            for first, count, lo, hi, t in zip(*(map(int, pdf[c]) for c in ("first", "count", "lo", "hi", "t"))):
                c, t = refine(poly, lo, hi, t, p.digits) if count == 1 else (hi, t)
                for i, v in enumerate(null_space(scatter, c, t, count, p.digits)):
                    yield pd.DataFrame({"nth": [first + i], "c": [str(c)], "t": [t], "v": [v.tolist()]})
    table = spark.createDataFrame([(a, b, str(lo), str(hi), t) for a, b, lo, hi, t in places], "first int, count int, lo string, hi string, t int")
    found = sorted(table.repartition(min(len(places), spark.sparkContext.defaultParallelism))
                   .mapInPandas(solve, "nth int, c string, t int, v array<double>").collect())[:p.components]
    return [Fraction(int(r["c"]), 1 << r["t"]) for r in found], np.array([r["v"] for r in found])


def _project(y: np.ndarray, n: int, total: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n * x - sum, exact, and its projection / n."""
    most = int(np.abs(y).max(initial=0)) * n + max(abs(int(v)) for v in total)
    if most * most * y.shape[1] < 1 << 63:
        centred = y * n - total.astype(np.int64)
    else:
        centred = y.astype(object) * n - total
    return centred, (centred / n).astype(np.float64) @ axes


def whiten(vectors: DataFrame, p: Params = Params()) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row a vector and component.

    Vectors that are null or empty, hold null or non-finite entries, or entries beyond 2^56 /
    ``scale``, are dropped; so are vectors of another length than the commonest (of equally
    common ones the shortest).  The covariance's eigenvalues that are zero have no component: fewer vectors than
    entries, or constant ones, give fewer components, one vector or an empty table give an
    empty result.  Equal eigenvalues share an arbitrary, but the same for all rows, orthonormal
    basis.  ``deviation`` is null where it exceeds a long.  Rows without vec_id, and rows
    that repeat one, are rows of their own.  Other columns are not read.
    """
    spark = vectors.sparkSession
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * p.scale < LARGEST))
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
            .filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.coalesce(fine, F.lit(False))))
    common = rows.groupBy(F.size("embedding").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if common is None:
        return spark.createDataFrame([], schema)
    dims, n = common["dims"], common["count"]
    rows = rows.filter(F.size("embedding") == dims)
    total, products = sums(rows, dims, p)
    total = np.array(total, object)
    scatter = products * n - np.outer(total, total)  # n^2 times the covariance, exactly
    if not np.trace(scatter):
        return spark.createDataFrame([], schema)
    roots, vecs = components(spark, scatter, p)
    trace = int(np.trace(scatter))
    axes = np.array([v / float(r / n**2) ** 0.5 for r, v in zip(roots, vecs)]).T
    explained = np.array([float(r / trace) for r in roots])
    k = len(roots)

    def moments(batches_):
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches(batches_):
            _, w = _project(_matrix(batch.column("embedding"), p), n, total, axes)
            first += w.sum(axis=0)
            second += w.T @ w
        values = np.r_[first, second[_cells(k)]]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["cell", "value"])

    values = np.zeros(k + k * (k + 1) // 2)
    for r in rows.select("embedding").mapInArrow(moments, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("v")).collect():
        values[r["cell"]] = r["v"]
    mean = values[:k] / n  # of centred values: next to nothing
    i, j = _cells(k)
    error = float(np.abs(values[k:] / n - mean[i] * mean[j] - (i == j)).max())

    def project(batches_):
        for whole in batches(batches_):
            for a in range(0, len(whole), 2048):
                batch = whole.slice(a, 2048)
                centred, w = _project(_matrix(batch.column("embedding"), p), n, total, axes)
                square = (centred * centred).sum(axis=1)
                deviation = pa.array([int(s) if s < 1 << 63 else None for s in square], pa.int64())
                at = pa.array(np.repeat(np.arange(len(w)), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(w))),
                     pa.array(np.full(len(at), n)), deviation.take(at), pa.array(w.ravel()), pa.array(np.tile(explained, len(w))),
                     pa.array(np.full(len(at), error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(project, schema)
