"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

Vectors are rounded to integers, so the scatter of the distinct ones is an exact
integer matrix.  Its characteristic polynomial is computed modulo many primes
(reduction to Hessenberg form, one Spark row a prime) and put together by Chinese
remaindering under a proven bound of the coefficients.  All roots of that
polynomial are real, so Descartes' rule counts the roots above any number exactly,
repeated ones included; bisection isolates each root to 80 bits.  A component
is found by inverse iteration in long integers at the isolated root.

Only d x d sums, d coefficients a prime and the components pass through the
driver; rows stay on the executors.
"""

from __future__ import annotations

from fractions import Fraction
from math import comb, gcd

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitmatch.llm.common import arrow_batch, pick, schema_of
from traitmatch.plans.lineage import cut_lineage

SCALE = 64                    # integers per unit of an entry
OFFSET = 1_000_000            # added to every integer; cancels in all results but x itself
COMPONENTS = 16
ROOT_BITS = 80                # relative width of an isolated root
WORK_BITS = 192               # fraction bits of the inverse iteration
LARGEST = 1 << 62             # entries beyond this are held at it
LIMB = 32
FIELDS = [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
          ("explained", "double"), ("identity_error", "double")]


# --- integer vectors ---------------------------------------------------------------

def integers(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the usable vectors (length ``d``, all entries finite) and floor(SCALE * c) of each."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows = np.nonzero(lengths == d)[0]
    flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)     # nulls become NaN
    values = np.asarray(flat, np.float64).reshape(len(rows), d)
    good = np.isfinite(values).all(axis=1)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(values[good] * SCALE), -float(LARGEST), float(LARGEST) - 1024)
    return rows[good], scaled.astype(np.int64)


def pack(z: np.ndarray) -> list[bytes]:
    """A key per row: the entries in the least of three widths that holds them all."""
    most = np.maximum(z.max(axis=1), -1 - z.min(axis=1)) if z.size else np.zeros(len(z), np.int64)
    out: list[bytes] = [b""] * len(z)
    for width, low, high in ((2, -1, 1 << 15), (4, (1 << 15) - 1, 1 << 31), (8, (1 << 31) - 1, 1 << 63)):
        at = np.nonzero((most > low) & (most < high))[0]
        small = z[at].astype(f"<i{width}")
        for i, row in zip(at.tolist(), small):
            out[i] = bytes((width,)) + row.tobytes()
    return out


def unpack(keys: list[bytes], d: int) -> np.ndarray:
    out = np.empty((len(keys), d), np.int64)
    for i, key in enumerate(keys):
        out[i] = np.frombuffer(key, f"<i{key[0]}", offset=1)
    return out


def dimension(vectors: DataFrame) -> int:
    """The length that most vectors have (ties: the longer; 0 without any)."""
    row = (vectors.filter(F.size("embedding") > 0).groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.col("n").desc(), F.col("d").desc()).first())
    return row.d if row else 0


def distinct_keys(vectors: DataFrame, d: int) -> DataFrame:
    """``key``: each distinct integer vector once."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(pack(integers(batch.column(0), d)[1]), pa.binary())], names=["key"])

    return vectors.select("embedding").mapInArrow(run, "key binary").distinct()


# --- exact scatter -----------------------------------------------------------------

def outer_sum(z: np.ndarray) -> np.ndarray:
    """Exact sum of z z^T as Python integers; in floats where every partial sum is exact there."""
    most = int(np.abs(z).max(initial=0))
    if len(z) * most * most < 1 << 53:
        f = z.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    if len(z) * most * most < 1 << 62:
        return (z.T @ z).astype(object)
    o = z.astype(object)
    return o.T @ o


def limbs(value: int) -> list[int]:
    """Base 2**LIMB digits, the last one signed, so that sums of digits fit in a long."""
    out = []
    while not -(1 << LIMB) <= value < 1 << LIMB:
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def scatter(keys: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """Number of vectors, their sums and n * sum(z z^T) - s s^T (n^2 times the covariance), all exact."""
    def run(batches):
        n, s, c = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            z = unpack(batch.column(0).to_pylist(), d)
            n += len(z)
            s = s + z.astype(object).sum(axis=0) if len(z) else s
            c = c + outer_sum(z)
        cells = [(-1, -1, n), *((-1, j, s[j]) for j in range(d)), *((i, j, c[i, j]) for i in range(d) for j in range(i, d))]
        made = [(i, j, k, v) for i, j, value in cells if value for k, v in enumerate(limbs(int(value)))]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
            zip(*made) if made else [[]] * 4, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))], names=["i", "j", "k", "v"])

    cells = keys.mapInArrow(run, "i int, j int, k int, v bigint").groupBy("i", "j", "k").agg(F.sum("v").alias("v"))
    total: dict[tuple[int, int], int] = {}
    for r in cells.toLocalIterator():                 # about d * d / 2 cells of a few limbs
        total[r.i, r.j] = total.get((r.i, r.j), 0) + (r.v << (LIMB * r.k))
    n, s = total.get((-1, -1), 0), [total.get((-1, j), 0) for j in range(d)]
    m = [[n * total.get((min(i, j), max(i, j)), 0) - s[i] * s[j] for j in range(d)] for i in range(d)]
    return n, s, m


# --- characteristic polynomial -----------------------------------------------------

def is_prime(n: int) -> bool:
    """Exact below 3.4e14 (these bases decide it)."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7, 11, 13, 17)):
        return n in (2, 3, 5, 7, 11, 13, 17)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7, 11, 13, 17):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_above(bound: int) -> list[int]:
    """Primes below 2**31, falling, whose product is greater than ``bound``."""
    out, product, p = [], 1, (1 << 31) - 1
    while product <= bound:
        if is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def hessenberg_polynomial(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(xI - M) modulo the prime ``p``, highest power first."""
    d = len(matrix)
    h = np.array([[v % p for v in row] for row in matrix], np.int64).reshape(d, d)
    for k in range(d - 2):
        below = np.nonzero(h[k + 1:, k])[0]
        if not len(below):
            continue
        r = k + 1 + int(below[0])
        if r != k + 1:
            h[[r, k + 1]] = h[[k + 1, r]]
            h[:, [r, k + 1]] = h[:, [k + 1, r]]
        u = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        # similarity: rows lose u times the pivot row, the pivot column gains the columns times u
        h[k + 2:] = (h[k + 2:] - u[:, None] * h[k + 1][None, :] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * u[None, :] % p).sum(axis=1)) % p
    # poly[k]: polynomial of the leading k x k block, lowest power first
    poly = np.zeros((d + 1, d + 1), np.int64)
    poly[0, 0] = 1
    for k in range(d):
        poly[k + 1, 1:] = poly[k, :-1]
        poly[k + 1] = (poly[k + 1] - poly[k] * h[k, k] % p) % p
        chain = 1
        for i in range(k - 1, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            if not chain:
                break
            poly[k + 1] = (poly[k + 1] - poly[i] * (chain * int(h[i, k]) % p) % p) % p
    return poly[d, ::-1].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Exact integer coefficients of det(xI - M) of a positive semidefinite M, highest power first.

    The k-th coefficient is an elementary symmetric function of eigenvalues that are not
    negative, at most binom(d, k) * (trace / d) ** k, with sign (-1) ** k.
    """
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    primes = primes_above(max(comb(d, k) * trace ** k // d ** k + 1 for k in range(d + 1)))

    def run(batches):
        for batch in batches:
            ps = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([hessenberg_polynomial(matrix, p) for p in ps], pa.list_(pa.int64()))],
                names=["p", "c"])

    tasks = min(len(primes), max(1, spark.sparkContext.defaultParallelism))
    frame = spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(tasks)
    values, modulus = [0] * (d + 1), 1
    for row in frame.mapInArrow(run, "p bigint, c array<bigint>").toLocalIterator():
        inverse = pow(modulus % row.p, -1, row.p)
        values = [v + modulus * ((c - v) * inverse % row.p) for v, c in zip(values, row.c)]
        modulus *= row.p
    return [v - modulus if k % 2 and v else v for k, v in enumerate(values)]


# --- roots -------------------------------------------------------------------------

def roots_above(polynomial: list[int], a: int, bits: int) -> int:
    """Roots greater than a / 2**bits of a polynomial with real roots only, with multiplicity.

    The polynomial is shifted by a; the changes of sign of its coefficients then count the
    positive roots exactly (Descartes).
    """
    c = [v << (bits * k) for k, v in enumerate(polynomial)]
    for stop in range(len(c) - 1, 0, -1):
        for j in range(1, stop + 1):
            c[j] += a * c[j - 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def isolate(polynomial: list[int], k: int, bound: int) -> tuple[int, int] | None:
    """(a, bits): the k-th largest root lies in (a - 1, a] / 2**bits, a width of 2**-ROOT_BITS of it.

    ``None`` if that root is not positive.  Repeated roots give the same interval.
    """
    if roots_above(polynomial, 0, 0) < k:
        return None
    low, high, bits = 0, bound, 0                    # roots_above(low) >= k > roots_above(high)
    while True:
        while high - low > 1:
            mid = (low + high) // 2
            if roots_above(polynomial, mid, bits) >= k:
                low = mid
            else:
                high = mid
        if low >> ROOT_BITS:
            return high, bits
        step = max(1, ROOT_BITS + 1 - low.bit_length())
        low, high, bits = low << step, high << step, bits + step


def null_space(matrix: list[list[int]], a: int, bits: int, size: int) -> np.ndarray:
    """``size`` orthonormal columns spanning the eigenspace at root a / 2**bits, by inverse iteration."""
    d, unit = len(matrix), 1 << WORK_BITS
    root = ((2 * a - 1) << WORK_BITS) >> (bits + 1)
    u = np.array([[(v << WORK_BITS) - (root if i == j else 0) for j, v in enumerate(row)]
                  for i, row in enumerate(matrix)], object).reshape(d, d)
    steps = []                                         # LU in fixed point, rows exchanged for the largest pivot
    for k in range(d):
        r = k + max(range(d - k), key=lambda i: abs(u[k + i, k]))
        if r != k:
            u[[k, r]] = u[[r, k]]
        if not u[k, k]:
            u[k, k] = 1                                # as near to singular as the format shows
        f = (u[k + 1:, k] << WORK_BITS) // u[k, k] if k + 1 < d else np.zeros(0, object)
        if len(f):
            u[k + 1:, k:] = u[k + 1:, k:] - ((f[:, None] * u[k, k:][None, :]) >> WORK_BITS)
        steps.append((r, f))

    def solve(b: np.ndarray) -> np.ndarray:
        b = b.copy()
        for k, (r, f) in enumerate(steps):
            b[k], b[r] = b[r], b[k]
            if len(f):
                b[k + 1:] = b[k + 1:] - ((f * b[k]) >> WORK_BITS)
        for k in range(d - 1, -1, -1):
            b[k] = (b[k] << WORK_BITS) // u[k, k]
            b[:k] = b[:k] - ((u[:k, k] * b[k]) >> WORK_BITS)
        most = max(map(abs, b)) or 1
        return np.array([(v << WORK_BITS) // most for v in b], object)

    rng = np.random.default_rng(d)
    out = np.zeros((d, size))
    for j in range(size):
        v = np.array([int(x) << (WORK_BITS - 20) for x in rng.integers(-(1 << 20), 1 << 20, d)], object)
        for _ in range(3):
            v = solve(v)
        w = np.array([float(Fraction(int(x), unit)) for x in v])
        for _ in range(2):                             # against the columns of the same root
            w = w - out[:, :j] @ (out[:, :j].T @ w)
            w /= np.linalg.norm(w)
        out[:, j] = w * np.sign(w[np.abs(w).argmax()])
    return out


class Whitener:
    """Means, components and eigenvalues of a fit; holds d * (components + 2) numbers."""

    def __init__(self, n: int, sums: list[int], scatter_: list[list[int]], eigenvalues: list[Fraction], axes: np.ndarray):
        self.n, self.sums = n, sums
        self.eigenvalues, self.axes = eigenvalues, axes
        self.trace = Fraction(sum(scatter_[i][i] for i in range(len(sums))), n * n) if n else Fraction(0)
        self.explained = [float(e / self.trace) for e in eigenvalues]
        self.scaled = axes / np.sqrt([float(e) for e in eigenvalues])[None, :] if eigenvalues else axes

    def deviations(self, z: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """n * x - S of every row, exact, and its sum of squares (null beyond a long)."""
        most = max([int(np.abs(z).max(initial=0)) * self.n, *map(abs, self.sums), 0])
        if z.shape[1] * 4 * most * most < 1 << 62:
            dev = z * self.n - np.array(self.sums, np.int64)[None, :]
            return dev, (dev * dev).sum(axis=1).tolist()
        dev = z.astype(object) * self.n - np.array(self.sums, object)[None, :]
        squares = (int(v) for v in (dev * dev).sum(axis=1))
        return dev, [v if v < 1 << 63 else None for v in squares]

    def whiten(self, dev: np.ndarray) -> np.ndarray:
        centred = (dev / self.n).astype(np.float64)     # x - S/n, from exact integers
        return centred @ self.scaled


def fit_whitener(keys: DataFrame, d: int, components: int = COMPONENTS) -> Whitener:
    """Fit on a table of distinct vectors.  Only components with a positive eigenvalue exist."""
    spark = keys.sparkSession
    n, sums, m = scatter(keys, d)
    shared = gcd(*(v for row in m for v in row)) if d else 0
    if not n or not shared:
        return Whitener(n, sums, m, [], np.zeros((d, 0)))
    small = [[v // shared for v in row] for row in m]
    polynomial = characteristic_polynomial(spark, small)
    bound = sum(small[i][i] for i in range(d)) + 1

    def find(batches):
        for batch in batches:
            found = [(k, isolate(polynomial, k, bound)) for k in batch.column(0).to_pylist()]
            found = [(k, str(r[0]), r[1]) for k, r in found if r]
            yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], t) for c, t in
                                              enumerate((pa.int64(), pa.string(), pa.int64()))], names=["k", "a", "bits"])

    wanted = min(components, d)
    frame = spark.range(1, wanted + 1).repartition(wanted)
    isolated = frame.mapInArrow(find, "k bigint, a string, bits bigint").orderBy("k").collect()     # a row a component
    groups: dict[tuple[int, int], int] = {}
    for r in isolated:
        groups[int(r.a), r.bits] = groups.get((int(r.a), r.bits), 0) + 1

    def vectors(batches):
        for batch in batches:
            ks, axes = [], []
            for k, a, bits, size in zip(*(c.to_pylist() for c in batch.columns)):
                for j, axis in enumerate(null_space(small, int(a), bits, size).T):
                    ks.append(k + j)
                    axes.append(axis.tolist())
            yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int64()), pa.array(axes, pa.list_(pa.float64()))],
                                             names=["k", "axis"])

    eigenvalues, roots, k = [], [], 1
    for (a, bits), size in groups.items():
        roots.append((k, str(a), bits, size))
        eigenvalues += [Fraction((2 * a - 1) * shared, (n * n) << (bits + 1))] * size
        k += size
    rows = (spark.createDataFrame(roots, "k bigint, a string, bits bigint, size bigint").repartition(max(1, len(roots)))
            .mapInArrow(vectors, "k bigint, axis array<double>").collect() if roots else [])
    axes = np.zeros((d, len(eigenvalues)))
    for r in rows:
        axes[:, r.k - 1] = r.axis
    return Whitener(n, sums, m, eigenvalues, axes)


def identity_error(keys: DataFrame, d: int, whitener: Whitener) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity."""
    k = len(whitener.eigenvalues)

    def run(batches):
        s, c = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = whitener.whiten(whitener.deviations(unpack(batch.column(0).to_pylist(), d))[0])
            s += w.sum(axis=0)
            c += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([i for i in range(k + 1) for _ in range(k)], pa.int32()),
                                          pa.array([j for _ in range(k + 1) for j in range(k)], pa.int32()),
                                          pa.array(np.concatenate([c.reshape(-1), s]))], names=["i", "j", "v"])

    total = np.zeros((k + 1, k))
    cells = keys.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    for r in cells.collect():                         # k * (k + 1) cells
        total[r.i, r.j] = r.v
    mean = total[k] / whitener.n                      # of rows that are centred already
    return float(np.abs(total[:k] / whitener.n - np.outer(mean, mean) - np.eye(k)).max(initial=0))


def whiten_embeddings(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                      components: int = COMPONENTS) -> DataFrame:
    """``FIELDS`` of every usable vector and component, up to ``components`` of them.

    A vector is dropped if it is null, holds a null or non-finite entry, or has another
    length than most vectors (ties: the longer length).  Repeated vectors enter the fit once and
    each get their rows; a null id stays null.  Components have a positive eigenvalue,
    so vectors that are all equal, a single vector and an empty table give no rows;
    equal eigenvalues get an orthonormal basis of their space.  Entries beyond 2**56
    are held there; a deviation beyond a long is null.  Other columns are ignored.
    """
    vectors = pick(embeddings, vec_id=id_col, embedding=vector_col).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    d = dimension(vectors)
    keys = cut_lineage(distinct_keys(vectors, d), "whitening_fit")
    whitener = fit_whitener(keys, d, components)
    error = identity_error(keys, d, whitener) if whitener.eigenvalues else 0.0
    k = len(whitener.eigenvalues)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                at, z = integers(part.column(1), d)
                dev, squares = whitener.deviations(z)
                rows = len(at)
                yield arrow_batch(FIELDS, [
                    part.column(0).take(pa.array(np.repeat(at, k))), np.tile(np.arange(1, k + 1, dtype=np.int32), rows),
                    np.full(rows * k, whitener.n), pa.array(squares, pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                    whitener.whiten(dev).reshape(-1), np.tile(whitener.explained, rows), np.full(rows * k, error)])

    return (vectors if k else vectors.limit(0)).mapInArrow(run, schema_of(FIELDS))
