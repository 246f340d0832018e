"""Whitening of embeddings by spectrum slicing.

Vectors become whole numbers, so that sums and products over all of them are
exact and the covariance is right to the last digit. Its leading eigenvalues
are found one by one: the signs of an LDLT factorisation of the covariance less
a shift tell how many eigenvalues lie above the shift; bisection by these counts
isolates the wanted one, Rayleigh quotient iteration goes to it, and two more
counts beside the result certify its number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgrain.llm.storage import stored

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Entries of larger size than this raise an error; their products would not be exact.
LARGEST = 1 << 40
#: Rows whose products of 20-bit numbers have an exact sum in double precision.
BLOCK = 1 << 12
HALF_BITS = 20
EPS = np.finfo(float).eps
#: Of the pivoting rule: keeps the growth of both kinds of pivots alike.
ALPHA = (1 + 17**0.5) / 8


def whole_vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per length the rows with only finite entries, and their vectors as whole numbers."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    good = column.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[starts])
    for d in np.unique(lengths[good]):
        rows = np.flatnonzero(good & (lengths == d))
        scaled = np.floor(SCALE * values[starts[rows][:, None] + np.arange(d)])
        if scaled.size and np.abs(scaled).max() >= LARGEST:
            raise ValueError(f"an embedding has an entry of {LARGEST // SCALE} or more")
        yield rows, scaled.astype(np.int64) + OFFSET


def exact(numbers: list[int]) -> pa.Array:
    return pa.array([Decimal(int(x)) if abs(int(x)) < 10**38 else None for x in numbers], pa.decimal128(38, 0))


def entry_sums(vectors: DataFrame) -> DataFrame:
    """``length``, ``place``, ``n`` and ``total``: over all vectors of a length; place -1 holds no total."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for rows, x in whole_vectors(batch.column(0)):
                n, total = sums.get(x.shape[1], (0, 0))
                sums[x.shape[1]] = n + len(rows), total + x.sum(axis=0).astype(object)
        for d, (n, total) in sums.items():
            columns = [pa.array([d] * (d + 1), pa.int32()), pa.array(range(-1, d), pa.int32()), pa.array([n] * (d + 1), pa.int64()), exact([0, *total])]
            yield pa.RecordBatch.from_arrays(columns, names=["length", "place", "n", "total"])

    partial = vectors.mapInArrow(work, "length int, place int, n bigint, total decimal(38,0)")
    return partial.groupBy("length", "place").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"))


def products(x: np.ndarray) -> np.ndarray:
    """The exact sums of products of the columns of ``x``, as Python numbers."""
    total = np.zeros((x.shape[1], x.shape[1]), dtype=object)
    for at in range(0, len(x), BLOCK):
        part = x[at : at + BLOCK]
        if np.abs(part).max(initial=0) < 1 << HALF_BITS:
            part = part.astype(float)
            total += (part.T @ part).astype(np.int64).astype(object)
        else:
            high, low = (part >> HALF_BITS).astype(float), (part & ((1 << HALF_BITS) - 1)).astype(float)
            squares, cross, rest = ((a.T @ b).astype(np.int64).astype(object) for a, b in ((high, high), (high, low), (low, low)))
            total += (squares << 2 * HALF_BITS) + ((cross + cross.T) << HALF_BITS) + rest
    return total


def product_sums(vectors: DataFrame, centre: np.ndarray) -> DataFrame:
    """``i``, ``j`` and ``total``: the sums of products of the entries less ``centre``, for i <= j."""
    d = len(centre)
    i, j = np.triu_indices(d)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), dtype=object)
        for batch in batches:
            for _, x in whole_vectors(batch.column(0)):
                if x.shape[1] == d:
                    total = total + products(x - centre)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), exact(total[i, j])], names=["i", "j", "total"])

    return vectors.mapInArrow(work, "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(F.sum("total").cast("decimal(38,0)").alias("total"))


def eigenvalues_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are larger than ``shift``.

    By Sylvester's law these are the positive pivots of an LDLT factorisation of
    the matrix less the shift, with pivots of one or two rows, chosen so that
    the rest does not grow.
    """
    a = matrix - shift * np.eye(len(matrix))
    above = 0
    while len(a):
        column = np.abs(a[1:, 0])
        largest = column.max(initial=0.0)
        pivot = 1
        if abs(a[0, 0]) < ALPHA * largest:
            r = 1 + int(column.argmax())
            row = np.abs(a[r])
            row[r] = 0
            if abs(a[0, 0]) * row.max() < ALPHA * largest**2:
                pivot = 1 if abs(a[r, r]) >= ALPHA * row.max() else 2
                order = np.arange(len(a))
                order[[pivot - 1, r]] = order[[r, pivot - 1]]
                a = a[np.ix_(order, order)]
        if pivot == 2:
            # a pivot of two rows has one eigenvalue on either side
            above += 1
            a = a[2:, 2:] - a[2:, :2] @ np.linalg.solve(a[:2, :2], a[:2, 2:])
        else:
            head = a[0, 0]
            above += head > 0
            a = a[1:, 1:] - np.outer(a[1:, 0] / head, a[0, 1:]) if head else a[1:, 1:]
    return above


class Slicer:
    """The leading eigenpairs of a symmetric matrix; counts made for one serve the next."""

    def __init__(self, matrix: np.ndarray) -> None:
        self.matrix, self.d = matrix, len(matrix)
        self.scale = float(np.abs(matrix).sum(axis=1).max())
        self.width = 4 * self.d * EPS * self.scale
        end = self.scale * (1 + 1e-9) + self.width
        self.counts = {-end: self.d, end: 0}
        self.vectors: list[np.ndarray] = []

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = eigenvalues_above(self.matrix, shift)
        return self.counts[shift]

    def interval(self, k: int) -> tuple[float, float]:
        """The closest shifts known with the k-th largest eigenvalue between them."""
        return max(s for s, n in self.counts.items() if n >= k), min(s for s, n in self.counts.items() if n < k)

    def isolate(self, k: int) -> tuple[float, float]:
        """An interval with the k-th eigenvalue alone, or one as narrow as rounding allows."""
        while True:
            low, high = self.interval(k)
            if high - low <= self.width or (self.counts[low] == k and self.counts[high] == k - 1):
                return low, high
            self.above((low + high) / 2)

    def orthogonal(self, x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for v in self.vectors:
                x = x - (v @ x) * v
        return x / np.linalg.norm(x)

    def pair(self, k: int) -> tuple[float, np.ndarray]:
        """The k-th largest eigenvalue and its vector, after those before it.

        Where the iteration leaves the interval or the counts beside its result
        deny it, the interval is halved by one more count.
        """
        rng = np.random.default_rng(k)
        low, high = self.isolate(k)
        allowed = self.width
        while True:
            x, shift = self.orthogonal(rng.standard_normal(self.d)), (low + high) / 2
            for _ in range(12):
                x = self.orthogonal(self.towards(shift, x))
                value = float(x @ self.matrix @ x)
                if not low - self.width <= value <= high + self.width:
                    break
                if np.linalg.norm(self.matrix @ x - value * x) <= allowed:
                    if self.above(value - 2 * allowed) >= k > self.above(value + 2 * allowed):
                        self.vectors.append(x)
                        return value, x
                    break
                shift = value
            if high - low > self.width:
                self.above((low + high) / 2)
                low, high = self.interval(k)
            else:
                # eigenvalues that rounding can't tell apart
                allowed *= 2

    def towards(self, shift: float, x: np.ndarray) -> np.ndarray:
        """A step of inverse iteration."""
        while True:
            try:
                return np.linalg.solve(self.matrix - shift * np.eye(self.d), x)
            except np.linalg.LinAlgError:
                shift += self.width


def leading_eigenpairs(matrix: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues in falling order and their unit vectors as columns."""
    m = min(components, len(matrix))
    if not np.abs(matrix).max(initial=0.0):
        return np.zeros(m), np.eye(len(matrix))[:, :m]
    slicer = Slicer(matrix)
    pairs = [slicer.pair(k) for k in range(1, m + 1)]
    return np.array([v for v, _ in pairs]), np.array([x for _, x in pairs]).T


@dataclass(frozen=True)
class Fit:
    """What projecting needs: counts, the whole part of the mean and what is left of the sums, eigenpairs."""

    n: int
    centre: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def usable(self) -> np.ndarray:
        """Components with a variance that is more than rounding."""
        return self.values > 8 * len(self.centre) * EPS * self.trace


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """The eigenpairs of all ``vectors`` (one array column) of the most frequent length above 0.

    Vectors that are null or have null or non-finite entries are left out; None
    if nothing remains. What reaches the driver follows the square of the length
    alone.
    """
    sums = stored(entry_sums(vectors))
    common = sums.where("place = -1 and length > 0").orderBy(F.desc("n"), F.desc("length")).first()
    if common is None:
        return None
    n, d = common["n"], common["length"]
    total = [int(r["total"]) for r in sums.where((F.col("length") == d) & (F.col("place") >= 0)).orderBy("place").collect()]
    centre = np.array([s // n for s in total], dtype=np.int64)
    rest = np.array([s % n for s in total], dtype=object)
    covariance = np.zeros((d, d))
    for r in product_sums(vectors, centre).collect():
        # exact until the one division
        i, j = r["i"], r["j"]
        covariance[i, j] = covariance[j, i] = (n * int(r["total"]) - rest[i] * rest[j]) / (n * n)
    return Fit(n, centre, rest, *leading_eigenpairs(covariance, components), float(np.trace(covariance)))


def deviations(x: np.ndarray, model: Fit) -> list[int]:
    """The exact sums of (n*x - S)^2 of the rows of ``x``, which are less the centre."""
    if np.abs(x).max(initial=0) ** 2 * x.shape[1] >= 1 << 62 or model.n * int(np.abs(x).max(initial=0)) * x.shape[1] >= 1 << 62:
        x = x.astype(object)
    squares, cross, own = (x * x).sum(axis=1), (x * model.rest.astype(x.dtype)).sum(axis=1), int((model.rest * model.rest).sum())
    return [model.n * model.n * int(s) - 2 * model.n * int(c) + own for s, c in zip(squares, cross, strict=True)]


def project(rows: DataFrame, model: Fit) -> DataFrame:
    """``_id``, ``deviation`` and ``whitened``, null where a component has no variance; ``rows`` has _id and _vector."""
    weights = model.vectors / np.sqrt(np.where(model.usable, model.values, 1.0))
    shift = np.array([r / model.n for r in model.rest])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in whole_vectors(batch.column(1)):
                if x.shape[1] != len(model.centre):
                    continue
                x = x - model.centre
                found = np.where(model.usable, (x - shift) @ weights, np.nan)
                flat = pa.array(found.ravel(), pa.float64(), from_pandas=True)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * found.shape[1], pa.int32()), flat)
                ids = batch.column(0).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([ids, exact(deviations(x, model)), lists], names=["_id", "deviation", "whitened"])

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"_id {kind}, deviation decimal(38,0), whitened array<double>")


def identity_error(projected: DataFrame, model: Fit) -> float | None:
    """The largest entry of the covariance of the whitened vectors less the identity."""
    used = np.flatnonzero(model.usable).tolist()
    if not used:
        return None
    pairs = [(a, b) for a in used for b in used if a <= b]
    found = projected.select(*(F.covar_pop(F.col("whitened")[a], F.col("whitened")[b]).alias(f"c{a}_{b}") for a, b in pairs)).first()
    return max(abs(c - (a == b)) for c, (a, b) in zip(found, pairs, strict=True))


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per vector and component: ``id_col``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    An entry c counts as ``floor(1024 * c) + 100000``. Rows whose vector is null
    or has null or non-finite entries are left out, and so are those of another
    length than the most frequent one (the longer of two as frequent). Components go by falling
    variance, from 1; ``whitened`` is null for one without variance, and ``explained`` if there is none at
    all. ``deviation`` is a decimal of 38 digits, null beyond them. Null and
    repeated ids are rows like any other; an empty table gives an empty result.
    Entries of 2^30 or more raise an error.
    """
    rows = embeddings.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_vector"))
    model = fit(rows.select("_vector"), components)
    if model is None:
        made = "component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
        kind = rows.schema["_id"].dataType.simpleString()
        return embeddings.sparkSession.createDataFrame([], f"_id {kind}, {made}").withColumnRenamed("_id", id_col)
    projected = stored(project(rows, model))
    error = identity_error(projected, model)
    shares = [float(v / model.trace) if model.trace else None for v in model.values]
    return projected.select(
        "_id", "deviation", F.posexplode("whitened").alias("_place", "whitened")
    ).select(
        F.col("_id").alias(id_col),
        (F.col("_place") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.array(*(F.lit(s).cast("double") for s in shares)), F.col("_place") + 1).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
