"""Whitening of vectors: leading eigenpairs of their covariance by spectrum slicing.

Sums, covariances and projections run where the vectors are; what meets on the driver is a matrix of
dimension by dimension. Its eigenvalues are counted above a shift by the signs of D in L D L^T
(Sylvester's law of inertia); bisection on the counts isolates each leading eigenvalue, Rayleigh
quotient iteration converges to it, and two counts next to it prove its number.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqloom.storage import stage

COMPONENTS = 16
#: The contract's grid. A cell c becomes floor(64 c) + 1000000.
GRID, ORIGIN = 64, 1_000_000
#: Vectors whose products are summed at a time.
BLOCK = 4096
#: Partial matrices that one task adds up; a sum of any number of them takes a few levels.
FAN = 64
#: Entries beyond have no exact place on the grid among whole numbers that doubles hold.
LARGEST = 2.0**46
#: Eigenvalues below this share of the largest are rounding; they have no component.
RANK = 1e-12
#: Shifts within this share of the norm are as near as rounding of the factors allows.
NEAR = 1e-13
#: Residuals within this share of the norm are converged; iteration goes on while they still shrink.
CONVERGED = 1e-13
#: Most steps of one iteration from one start. It converges in three to six.
STEPS = 12


class Spectrum(NamedTuple):
    """Eigenvalues by falling size, their unit eigenvectors as rows, and whether counts certify each number."""

    values: np.ndarray
    vectors: np.ndarray
    certified: np.ndarray


def inertia(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``matrix`` exceed ``shift``: positive signs of D in L D L^T of matrix - shift.

    Pivots are chosen on the diagonal, of one row or two (Bunch and Kaufman 1977), so that factors stay
    bounded for indefinite matrices. A pivot of exact zero counts as not above.
    """
    a = np.array(matrix, float)
    a[np.diag_indices_from(a)] -= shift
    n, k, above = len(a), 0, 0
    alpha = (1 + 17**0.5) / 8
    while k < n:
        column = np.abs(a[k + 1 :, k])
        r = k + 1 + int(column.argmax()) if len(column) else k
        largest = column[r - k - 1] if len(column) else 0.0
        pair = False
        if max(abs(a[k, k]), largest) == 0:
            k += 1
            continue
        if abs(a[k, k]) < alpha * largest:
            others = np.abs(a[r, k:])
            others[r - k] = 0
            sigma = others.max()
            if abs(a[k, k]) * sigma < alpha * largest**2:
                if abs(a[r, r]) >= alpha * sigma:
                    _swap(a, k, r)
                else:
                    _swap(a, k + 1, r)
                    pair = True
        if pair:
            # a pair of rows whose determinant is negative: one eigenvalue on either side
            block, rest = a[k : k + 2, k : k + 2], a[k + 2 :, k : k + 2]
            determinant = block[0, 0] * block[1, 1] - block[0, 1] * block[1, 0]
            above += 1 if determinant < 0 else 2 * int(block[0, 0] + block[1, 1] > 0)
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(block, rest.T)
            k += 2
        else:
            above += int(a[k, k] > 0)
            rest = a[k + 1 :, k]
            a[k + 1 :, k + 1 :] -= np.outer(rest, rest / a[k, k])
            k += 1
    return above


def _swap(a: np.ndarray, i: int, j: int) -> None:
    if i != j:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]


def leading(matrix: np.ndarray, count: int) -> Spectrum:
    """The ``count`` largest eigenvalues above RANK of the largest, by counts, bisection and Rayleigh quotients.

    Equal eigenvalues, and those that rounding cannot tell apart, share an interval; each then starts
    orthogonal to the ones found before, so any orthonormal basis of theirs may come back.
    """
    norm = float(np.abs(matrix).sum(axis=1).max(initial=0))
    values, vectors, certified = [], [], []
    if norm == 0:
        return Spectrum(np.zeros(0), np.zeros((0, len(matrix))), np.zeros(0, bool))
    draw = np.random.default_rng(0)
    # how many eigenvalues exceed each shift tried so far
    above = {-norm * NEAR: len(matrix), norm * (1 + NEAR): 0}
    for k in range(1, min(count, len(matrix)) + 1):
        found = None
        while found is None:
            low, high = max(s for s, c in above.items() if c >= k), min(s for s, c in above.items() if c < k)
            near = high - low <= norm * NEAR
            if near or (above[low] == k and above[high] == k - 1):
                value, vector, rest = _iterate(matrix, (low + high) / 2, vectors, draw)
                # one that ran to another eigenvalue, or not far enough, starts nearer
                if near or (low <= value <= high and rest <= norm * CONVERGED):
                    found = value, vector
            if found is None:
                middle = (low + high) / 2
                above[middle] = inertia(matrix, middle)
        value, vector = found
        if values and value <= RANK * values[0]:
            break
        gap = 8 * norm * NEAR
        values.append(value)
        vectors.append(vector)
        certified.append(inertia(matrix, value + gap) < k <= inertia(matrix, value - gap))
    return Spectrum(np.array(values), np.array(vectors).reshape(len(values), len(matrix)), np.array(certified, bool))


def _iterate(matrix, shift, known, draw) -> tuple[float, np.ndarray, float]:
    """An eigenpair near ``shift``, orthogonal to ``known``, and its residual: two inverse iterations, then Rayleigh quotient iteration."""
    basis = np.array(known).reshape(len(known), len(matrix))
    clean = lambda v: v - basis.T @ (basis @ v)
    unit = lambda v: v / np.linalg.norm(v)
    norm = float(np.abs(matrix).sum(axis=1).max())
    vector, value, best = unit(clean(clean(draw.standard_normal(len(matrix))))), shift, np.inf
    for step in range(STEPS):
        try:
            solved = np.linalg.solve(matrix - value * np.eye(len(matrix)), vector)
        except np.linalg.LinAlgError:
            value += np.spacing(norm)
            continue
        if not np.isfinite(solved).all():
            break
        vector = unit(clean(clean(unit(solved))))
        rest = float(np.linalg.norm(matrix @ vector - (vector @ matrix @ vector) * vector))
        if rest <= norm * CONVERGED and rest >= best / 2:
            break
        best = rest
        if step:
            value = float(vector @ matrix @ vector)
    return float(vector @ matrix @ vector), vector, best


# --- passes over the vectors -------------------------------------------------------------


def grid(vector: Column) -> Column:
    """Every entry as a whole number on the grid."""
    return F.transform(vector, lambda c: (F.floor(c.cast("double") * GRID) + ORIGIN).cast("long"))


def usable(vector: Column) -> Column:
    """True where a vector is there and all its entries are finite and below LARGEST."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < LARGEST))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine, F.lit(False))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


_SUMS = T.StructType([T.StructField("sums", T.ArrayType(T.DoubleType()))])


def _partial(of_block):
    """One row per task: the sum over its blocks of what ``of_block`` makes of a matrix of whole numbers."""

    def run(batches):
        total = None
        for batch in batches:
            rows = _matrix(batch.column(0))
            for k in range(0, len(rows), BLOCK):
                part = of_block(rows[k : k + BLOCK])
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["sums"])

    return run


def _summed(rows: DataFrame, of_block, name: str) -> np.ndarray:
    """The sum of ``of_block`` over all ``rows``: one matrix per task, added up FAN at a time."""
    partials = stage(rows.mapInArrow(_partial(of_block), _SUMS), name)
    while (count := partials.count()) > 1:
        fewer = partials.repartition(-(-count // FAN))
        partials = stage(fewer.mapInArrow(_partial(lambda block: block.sum(axis=0)), _SUMS), name)
    return np.array(partials.first().sums)


class Centre(NamedTuple):
    """The mean as whole numbers and what they leave, so that centring rounds once."""

    base: np.ndarray
    rest: np.ndarray
    n: int

    def of(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.base) - self.rest / self.n

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """The sum of (n x - S)^2 of each row, exact; None outside the range of a long."""
        apart = rows - self.base
        most = self.n * (int(np.abs(apart).max(initial=0)) + 1)
        if most * most * max(rows.shape[1], 1) < 1 << 63:
            return ((self.n * apart - self.rest) ** 2).sum(axis=1).tolist()
        exact = (sum((self.n * x - r) ** 2 for x, r in zip(row, self.rest.tolist(), strict=True)) for row in apart.tolist())
        return [x if x < 1 << 63 else None for x in exact]


def _centre(fit: DataFrame, dim: int) -> Centre:
    """Exact sums by dimension: as many rows as dimensions leave each task."""
    cells = fit.select(F.lit(1).alias("one"), F.posexplode("x").alias("d", "x"))
    sums = cells.groupBy("d").agg(F.count("*").alias("n"), F.sum(F.col("x").cast("decimal(20,0)")).alias("s")).collect()
    n = sums[0].n
    total = {r.d: int(r.s) for r in sums}
    base = np.array([total[d] // n for d in range(dim)])
    return Centre(base, np.array([total[d] % n for d in range(dim)]), n)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: id, component, n, deviation, whitened, explained, certified, identity_error.

    The fit list is every different grid vector once: n of them, with sums S. Their covariance V is
    centred before it is multiplied. A row's whitened value is its centred grid vector on the unit
    eigenvector, over the root of the eigenvalue; explained is the eigenvalue's share of the trace;
    identity_error is the largest entry of the whitened fit list's own covariance less the identity.
    deviation is the sum of (n x - S)^2, exact; null where it leaves the range of a long.

    Rows whose vector is null, empty or holds a null or non-finite entry, or one beyond LARGEST, give none. Vectors of another
    length than the commonest (the shortest of several) have no place in the same space and give none
    either. Rows that repeat an id or have none each give their own. Fewer components than asked come
    back where V has fewer eigenvalues above rounding: none for one vector, many times over, or for an
    empty table. Other columns are not read.
    """
    spark = vectors.sparkSession
    kept = vectors.select(F.col(id_col), F.col(vector_col).alias("_vector")).where(usable(F.col("_vector")))
    lengths = kept.groupBy(F.size("_vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    result = T.StructType(
        [
            vectors.schema[id_col],
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("certified", T.BooleanType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    if lengths is None:
        return spark.createDataFrame([], result)
    dim = lengths.length
    rows = kept.where(F.size("_vector") == dim).select(id_col, grid(F.col("_vector")).alias("x"))
    fit = stage(rows.select("x").distinct(), "whitening-fit")
    centre = _centre(fit, dim)
    n = centre.n
    covariance = _summed(fit, _products(centre), "whitening-products").reshape(dim, dim) / n
    covariance = (covariance + covariance.T) / 2
    found = leading(covariance, components)
    if not len(found.values):
        return spark.createDataFrame([], result)
    weights = (found.vectors / np.sqrt(found.values)[:, None]).T
    spread = _summed(fit, _products(centre, weights), "whitening-check").reshape(len(found.values), -1) / n
    error = float(np.abs(spread - np.eye(len(found.values))).max())
    explained = found.values / np.trace(covariance)
    return rows.mapInArrow(_project(id_col, centre, weights, explained, found.certified, error), result)


def _products(centre: Centre, weights: np.ndarray | None = None):
    """Sums of products of centred rows, or of what ``weights`` make of them."""

    def of_block(rows):
        centred = centre.of(rows) if weights is None else centre.of(rows) @ weights
        return centred.T @ centred

    return of_block


def _project(id_col, centre, weights, explained, certified, error):
    count = weights.shape[1]

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                rows = _matrix(batch.column(1))
                white = centre.of(rows) @ weights
                size = len(rows)
                place = pa.array(np.repeat(np.arange(size), count))
                deviations = pa.array(centre.deviations(rows), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(place),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), size)),
                        pa.array(np.full(size * count, centre.n)),
                        deviations.take(place),
                        pa.array(white.ravel()),
                        pa.array(np.tile(explained, size)),
                        pa.array(np.tile(certified, size)),
                        pa.array(np.full(size * count, error)),
                    ],
                    [id_col, "component", "n", "deviation", "whitened", "explained", "certified", "identity_error"],
                )

    return run
