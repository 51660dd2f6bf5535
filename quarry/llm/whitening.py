"""Whitening of embeddings by their leading principal components.

Entries become whole numbers ``x = floor(1024 * c) + 100000``. Two passes over
the rows add up exact whole numbers: the sums, then the products of entries
centred on the nearest whole number to their mean; the centred covariance
follows from these without rounding. Its leading eigenpairs come from
Householder tridiagonalisation, bisection on Sturm counts and inverse iteration
with reorthogonalisation inside clusters of eigenvalues, on a matrix of the
vectors' dimension. The projection is broadcast; a third pass measures the
covariance of what it gives.

Defined cases: a row with a null vector, or a null or non-finite entry, is left
out; a null id is kept as it is; entries that a shorter vector lacks count as
c = 0; repeated rows count as often as they occur and each get their rows.
There are at most as many components as the covariance has rank (one whose
eigenvalue is under 1e-13 of the largest is none), so vectors that are all
alike, or an empty table, give an empty result. Other columns are ignored. An
entry of 2**40 or more is an error (``ArithmeticError``).
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LIMIT = 1 << 40
RANK_TOLERANCE = 1e-13
#: Eigenvalues closer than this share of the matrix's norm are one cluster.
CLUSTER = 1e-3
SUMS = "i int, j int, total decimal(38,0)"


def remaining(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector as doubles) of the rows that take part."""
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.select(F.col(id_col).alias("id"), vector.alias("vector")).where(F.col("vector").isNotNull() & finite)


def whole_numbers(b: pa.RecordBatch, width: int) -> np.ndarray:
    """x of every entry, one row per vector."""
    lists = b.column("vector")
    sizes = np.asarray(lists.value_lengths(), dtype=np.int64)
    out = np.full((len(sizes), width), SHIFT, np.int64)
    c = np.floor(np.asarray(lists.flatten(), dtype=np.float64) * SCALE)
    if len(c) and np.abs(c).max() >= LIMIT:
        raise ArithmeticError("an entry of 2**40 or more after scaling")
    out[np.arange(width)[None, :] < sizes[:, None]] = c.astype(np.int64) + SHIFT
    return out


def exact_product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x.T @ y of whole numbers, exact."""
    most = int(np.abs(x).max(initial=0)) * int(np.abs(y).max(initial=0)) * max(len(x), 1)
    if most < 1 << 53:
        return (x.astype(np.float64).T @ y.astype(np.float64)).astype(np.int64)
    if most < 1 << 63:
        return x.T @ y
    return x.astype(object).T @ y.astype(object)


def _totals(parts: dict[tuple[int, int], int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "i": pa.array([i for i, _ in parts], pa.int32()), "j": pa.array([j for _, j in parts], pa.int32()),
        "total": pa.array([Decimal(v) for v in parts.values()], pa.decimal128(38, 0))})


def added_up(rows: DataFrame, width: int, centre: list[int] | None = None) -> dict[tuple[int, int], int]:
    """Exact sums over all rows: of x at (i, -1) and of ones at (-1, -1); with a
    ``centre`` z = x - centre in place of x, and also of z_i z_j at (i, j), j <= i."""
    middle = np.array(centre or [0] * width, np.int64)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products, n = [0] * width, np.zeros((width, width), object), 0
        for b in batches:
            z = whole_numbers(b, width) - middle
            sums = [a + int(v) for a, v in zip(sums, z.sum(axis=0), strict=True)]
            n += len(z)
            if centre is not None:
                products = products + exact_product(z, z)
        if n:
            out = {(-1, -1): n} | {(i, -1): s for i, s in enumerate(sums)}
            if centre is not None:
                out |= {(i, j): int(products[i, j]) for i in range(width) for j in range(i + 1)}
            yield _totals(out)

    # one row per entry of the matrix and task, added up by Spark
    found = rows.mapInArrow(add, SUMS).groupBy("i", "j").agg(F.sum("total").alias("total"))
    return {(r["i"], r["j"]): int(r["total"]) for r in found.collect()}


def covariance(totals: dict[tuple[int, int], int], width: int) -> np.ndarray:
    """Rounded once: (n * sum z_i z_j - sum z_i * sum z_j) / n**2."""
    n = totals[-1, -1]
    out = np.zeros((width, width))
    for i in range(width):
        for j in range(i + 1):
            out[i, j] = out[j, i] = float(Fraction(n * totals[i, j] - totals[i, -1] * totals[j, -1], n * n))
    return out


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit Householder vectors that lead there."""
    a = matrix.copy()
    n = len(a)
    reflectors = []
    for k in range(n - 2):
        u = np.zeros(n)
        u[k + 1:] = a[k + 1:, k]
        norm = np.linalg.norm(u)
        if norm:
            u[k + 1] += np.copysign(norm, u[k + 1])
            u /= np.linalg.norm(u)
            p = a @ u
            w = p - (u @ p) * u
            a -= 2 * (np.outer(u, w) + np.outer(w, u))
        reflectors.append(u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflectors


def sturm_count(d: np.ndarray, e: np.ndarray, at: float) -> int:
    """How many eigenvalues of the tridiagonal matrix are less than ``at``."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    count, q = 0, 1.0
    for k in range(len(d)):
        q = d[k] - at - (e[k - 1] ** 2 / q if k else 0.0)
        if abs(q) < tiny:
            q = -tiny
        count += q < 0
    return count


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> list[float]:
    """The ``k`` largest, falling, each bisected until the interval can't be halved."""
    n = len(d)
    reach = np.concatenate([[0], np.abs(e)]) + np.concatenate([np.abs(e), [0]])
    lowest, highest = float((d - reach).min()), float((d + reach).max())
    margin = 1e-10 * max(abs(lowest), abs(highest)) + np.finfo(float).tiny
    out = []
    for number in range(1, k + 1):
        low, high = lowest - margin, highest + margin
        while low < (middle := (low + high) / 2) < high:
            if sturm_count(d, e, middle) > n - number:
                high = middle
            else:
                low = middle
        out.append((low + high) / 2)
    return out


def _solve(d: np.ndarray, e: np.ndarray, at: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """x of (T - at) x = b by elimination with row exchanges."""
    n = len(d)
    main, upper, second, x = d - at, np.append(e, 0.0), np.zeros(n), b.copy()
    lower = e.copy()
    for k in range(n - 1):
        if abs(lower[k]) > abs(main[k]):
            main[k], lower[k] = lower[k], main[k]
            upper[k], main[k + 1] = main[k + 1], upper[k]
            second[k], upper[k + 1] = upper[k + 1], 0.0
            x[k], x[k + 1] = x[k + 1], x[k]
        if abs(main[k]) < tiny:
            main[k] = tiny
        f = lower[k] / main[k]
        main[k + 1] -= f * upper[k]
        upper[k + 1] -= f * second[k]
        x[k + 1] -= f * x[k]
    if abs(main[-1]) < tiny:
        main[-1] = tiny
    for k in range(n - 1, -1, -1):
        rest = x[k] - (upper[k] * x[k + 1] if k + 1 < n else 0.0) - (second[k] * x[k + 2] if k + 2 < n else 0.0)
        x[k] = rest / main[k]
    return x


def eigenvectors(d: np.ndarray, e: np.ndarray, values: list[float]) -> np.ndarray:
    """A unit eigenvector (row) for each of ``values`` by inverse iteration; those
    of a cluster are kept orthogonal in every step."""
    norm = max(np.abs(d).max(), np.abs(e).max(initial=0.0)) or 1.0
    tiny = np.finfo(float).eps * norm
    random = np.random.default_rng(1)
    out: list[np.ndarray] = []
    cluster: list[int] = []
    shift = 0.0
    for k, value in enumerate(values):
        near = bool(k) and values[k - 1] - value <= CLUSTER * norm
        cluster = [*cluster, k - 1] if near else []
        # equal eigenvalues are shifted apart a little, or the same vector would come again
        shift = min(value, shift - 4 * tiny) if near else value
        x = random.uniform(-1, 1, len(d))
        for _ in range(6):
            for _ in range(2):
                for m in cluster:
                    x -= (out[m] @ x) * out[m]
            x /= np.linalg.norm(x)
            x = _solve(d, e, shift, x, tiny)
        for _ in range(2):
            for m in cluster:
                x -= (out[m] @ x) * out[m]
        out.append(x / np.linalg.norm(x))
    return np.array(out)


def leading_eigenpairs(matrix: np.ndarray, k: int) -> tuple[list[float], np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as rows."""
    scale = np.abs(matrix).max(initial=0.0)
    k = min(k, len(matrix))
    if not k or not scale:
        return [], np.zeros((0, len(matrix)))
    d, e, reflectors = tridiagonal(matrix / scale)
    values = leading_eigenvalues(d, e, k)
    values = [v for v in values if v > RANK_TOLERANCE * values[0]]
    vectors = eigenvectors(d, e, values)
    for u in reversed(reflectors):
        vectors -= 2 * np.outer(vectors @ u, u)
    return [v * scale for v in values], vectors


def whitened(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
             components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row
    for each remaining row of ``rows`` and component; ``deviation`` is decimal(38,0)."""
    spark = rows.sparkSession
    part = stored(spark, remaining(rows, id_col, vector_col), "whitening")
    width = part.agg(F.max(F.size("vector"))).first()[0] or 0
    totals = added_up(part, width)
    if not totals or not width:
        return _empty(spark, part)
    n, sums = totals[-1, -1], [totals[i, -1] for i in range(width)]
    centre = [(2 * s + n) // (2 * n) for s in sums]  # the whole number nearest to the mean
    centred = covariance(added_up(part, width, centre), width)
    values, vectors = leading_eigenpairs(centred, components)
    if not values:
        return _empty(spark, part)
    trace = float(np.trace(centred))
    rest = np.array([float(Fraction(s, n) - m) for s, m in zip(sums, centre, strict=True)])  # mean less centre
    plan = spark.sparkContext.broadcast((np.array(centre, np.int64), rest, (vectors / np.sqrt(values)[:, None]).T))

    def project(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        middle, left, onto = plan.value
        x = whole_numbers(b, width)
        return x, ((x - middle) - left) @ onto

    error = _identity_error(part, project, len(values))
    explained = np.array(values) / trace

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, out = project(b)
            k = out.shape[1]
            d = [Decimal(v) for v in _deviations(x, n, sums)]
            where = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(where)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                 pa.array(np.full(len(where), n), pa.int64()), pa.array(d, pa.decimal128(38, 0)).take(pa.array(where)),
                 pa.array(out.reshape(-1)), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(where), error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return part.mapInArrow(lay_out, _schema(part))


def _schema(part: DataFrame) -> str:
    return (f"vec_id {part.schema['id'].dataType.simpleString()}, component int, n long, deviation decimal(38,0), "
            "whitened double, explained double, identity_error double")


def _empty(spark: SparkSession, part: DataFrame) -> DataFrame:
    return spark.createDataFrame([], _schema(part))


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """The exact sum of (n * x - S)**2 of each row."""
    far = max((abs(n * int(v) - s) for col, s in zip(x.T, sums, strict=True) for v in (col.min(), col.max())), default=0)
    if far * far * x.shape[1] < 1 << 63:
        return ((x * n - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    d = x.astype(object) * n - np.array(sums, object)
    return (d * d).sum(axis=1).tolist()


def _identity_error(part: DataFrame, project, k: int) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the
    identity: each task's mean and centred products, merged pair by pair."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for b in batches:
            if b.num_rows:
                y = project(b)[1]
                m = y.mean(axis=0)
                n, mean, products = _merged((n, mean, products), (len(y), m, (y - m).T @ (y - m)))
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n], "mean": [mean.tolist()], "products": [products.ravel().tolist()]})

    schema = "n long, mean array<double>, products array<double>"
    tasks = part.mapInArrow(measure, schema)
    parts = tasks.rdd.map(lambda r: (r[0], np.array(r[1]), np.array(r[2]).reshape(k, k)))
    n, _, products = parts.treeReduce(_merged, depth=3)
    return float(np.abs(products / n - np.eye(k)).max())


def _merged(a: tuple, b: tuple) -> tuple:
    n = a[0] + b[0]
    apart = b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)
