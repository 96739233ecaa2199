"""Whitening of vectors by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance are found without forming it: every pass over the
vectors multiplies it with a block of columns, as the sum of centred X'(XQ) over the tasks,
and only that product, dimensions by columns, comes back. Between passes the driver runs the
three-term Chebyshev recurrence, which damps the eigenvalues in an interval and lets those
above it grow, then takes a QR factorisation and the Ritz pairs of the block. The interval
ends at the least Ritz value; it begins at a lower bound of the spectrum from a Lanczos
recurrence that rides along in the first passes as one more column. Cycles go on until the
residuals of all wanted pairs certify them; where a cycle gains little, because the spectrum
has no gap there, the block is doubled, up to all dimensions, where the Ritz pairs are exact.

The vectors are whole numbers, kept in a stored table of packed blocks, so that a pass costs
one read and two matrix products. Sums are exact; a centred entry is (n * x - S) / n, rounded
once.

Defined results: vectors that are NULL or empty, hold a NULL entry or one beyond 2**40, or
have another width than most (the wider where widths are equally common), are left out. No
vector gives no rows. A component without variance has NULL ``whitened`` and explains 0; of
all-equal vectors every component is such, and ``identity_error`` is NULL. ``deviation`` is
NULL where it does not fit a long. Equal eigenvalues leave their vectors open; one choice is
made for all rows, with the largest entry of a component positive. Repeated rows count and are
answered each; other columns are left aside, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdgrid.session import materialise

COMPONENTS = 8
# Columns of the first block for every wanted component.
COLUMNS_PER_COMPONENT = 4
# Products in a cycle, and cycles at most before a block must be doubled.
DEGREE = 8
MOST_CYCLES = 20
# Residuals, as parts of the greatest eigenvalue, that certify a pair; those that may stay
# where a cycle gains nothing more, which is as far as rounding lets them fall.
CERTIFIED = 1e-14
ROUNDED = 1e-12
# Vectors in a packed block.
BLOCK_ROWS = 4096
MOST_ENTRY = 1 << 40
SEED = 7

PACKED = "ids array<bigint>, x binary, wide boolean, sums array<bigint>"
WHITENED = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


@dataclass(frozen=True)
class Fit:
    """What all vectors share: number, sums, trace of the covariance, eigenpairs, residuals."""

    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    passes: int


def usable(x: Column) -> Column:
    """Whether a vector of longs can be fitted."""
    odd = F.exists(x, lambda v: v.isNull() | (F.abs(v) > F.lit(MOST_ENTRY)))
    return x.isNotNull() & (F.size(x) > 0) & ~odd


def pack(vectors: DataFrame) -> tuple[DataFrame, int]:
    """Store the usable vectors as blocks; the table and the width of the vectors."""
    good = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("x").cast("array<long>").alias("x")
    ).filter(usable(F.col("x")))
    sizes = good.groupBy(F.size("x").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    width = most["size"] if most else 0

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = part.column("x").flatten().to_numpy().reshape(part.num_rows, width)
                wide = bool(np.abs(x).max() >= 1 << 31)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                        pa.array([x.astype("<i8" if wide else "<i4").tobytes()], pa.binary()),
                        pa.array([wide]),
                        pa.array([x.sum(axis=0).tolist()], pa.list_(pa.int64())),
                    ],
                    names=["ids", "x", "wide", "sums"],
                )

    return materialise(good.filter(F.size("x") == width).mapInArrow(packed, PACKED)), width


def _totals(blocks: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """The number of vectors and the exact sum of each dimension."""
    n = blocks.agg(F.sum(F.size("ids")).cast("long")).first()[0] or 0
    sums = blocks.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s"))
    found = np.zeros(width, dtype=np.int64)
    for row in sums.collect():
        found[row["i"]] = row["s"]
    return n, found


def _deviations(x: bytes, wide: bool, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S of a packed block, exact."""
    entries = np.frombuffer(x, "<i8" if wide else "<i4").reshape(-1, len(sums))
    return entries.astype(np.int64) * n - sums


def _summed(blocks: DataFrame, per_block: Callable[[np.ndarray], np.ndarray], n: int, sums: np.ndarray) -> np.ndarray:
    """The sum over all blocks of an array made from their centred vectors."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x, wide in zip(batch.column("x"), batch.column("wide")):
                one = per_block(_deviations(x.as_py(), wide.as_py(), n, sums) / n)
                total = one if total is None else total + one
        if total is not None:
            cells = [pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())]
            yield pa.RecordBatch.from_arrays(cells, names=["cell", "value"])

    parts = blocks.select("x", "wide").mapInArrow(partial, "cell int, value double")
    rows = parts.groupBy("cell").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(len(rows))
    for row in rows:
        out[row["cell"]] = row["value"]
    return out


class _Covariance:
    """Products with the covariance, each one pass over the blocks."""

    def __init__(self, blocks: DataFrame, n: int, sums: np.ndarray) -> None:
        self.blocks, self.n, self.sums, self.passes = blocks, n, sums, 0

    def __matmul__(self, q: np.ndarray) -> np.ndarray:
        self.passes += 1
        total = _summed(self.blocks, lambda a: a.T @ (a @ q), self.n, self.sums)
        return total.reshape(q.shape) / self.n

    def trace(self) -> float:
        total = _summed(self.blocks, lambda a: np.array([np.einsum("ij,ij->", a, a)]), self.n, self.sums)
        return float(total[0]) / self.n


class _Lanczos:
    """A recurrence for one vector, which gives a lower bound of the spectrum."""

    def __init__(self, start: np.ndarray) -> None:
        self.basis = [start / np.linalg.norm(start)]
        self.alpha: list[float] = []
        self.beta: list[float] = []

    def step(self, product: np.ndarray) -> bool:
        """Take the product with the last vector; whether the recurrence goes on."""
        q = self.basis[-1]
        self.alpha.append(float(q @ product))
        rest = product - sum(b * (b @ product) for b in self.basis)
        rest = rest - sum(b * (b @ rest) for b in self.basis)
        self.beta.append(float(np.linalg.norm(rest)))
        if self.beta[-1] <= 1e-12 * abs(self.alpha[0]) or len(self.basis) == len(q):
            return False
        self.basis.append(rest / self.beta[-1])
        return True

    def lower(self) -> float:
        inner = self.beta[:-1]
        line = np.diag(self.alpha) + np.diag(inner, 1) + np.diag(inner, -1)
        return max(0.0, float(np.linalg.eigvalsh(line)[0]) - self.beta[-1])


def leading(
    covariance, width: int, components: int = COMPONENTS, columns: int | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The greatest eigenvalues, falling, with unit eigenvectors in columns and residuals.

    ``covariance @ q`` must give the product with a block.
    """
    rng = np.random.default_rng(SEED)
    wanted = min(components, width)
    size = min(width, columns or COLUMNS_PER_COMPONENT * wanted)
    q = np.linalg.qr(rng.standard_normal((width, size)))[0]
    values, q, residuals = _ritz(covariance, q)
    lanczos: _Lanczos | None = _Lanczos(rng.standard_normal(width))
    lower, worst, cycles = 0.0, np.inf, 0
    while True:
        before, worst = worst, float(residuals[:wanted].max())
        top = float(values[0])
        if worst <= CERTIFIED * top or (worst <= ROUNDED * top and worst > before / 2) or size == width:
            return values[:wanted], _signed(q[:, :wanted]), residuals[:wanted]
        if cycles >= MOST_CYCLES or (cycles > 1 and worst > before / 10):
            size, cycles, worst = min(width, 2 * size), 0, np.inf
            q = np.hstack([q, rng.standard_normal((width, size - q.shape[1]))])
            values, q, residuals = _ritz(covariance, np.linalg.qr(q)[0])
            continue
        upper = float(values[-1])
        q, lanczos, bound = _filtered(covariance, q, lower, upper, lanczos)
        lower = min(bound, upper / 2) if bound is not None and bound >= upper else bound or lower
        values, q, residuals = _ritz(covariance, np.linalg.qr(q)[0])
        cycles += 1


def _ritz(covariance, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values, falling, and vectors of a block with orthonormal columns; residuals."""
    product = covariance @ q
    inner = q.T @ product
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    q, product = q @ turn, product @ turn
    return values, q, np.linalg.norm(product - q * values, axis=0)


def _filtered(
    covariance, q: np.ndarray, lower: float, upper: float, lanczos: _Lanczos | None
) -> tuple[np.ndarray, _Lanczos | None, float | None]:
    """The block after a Chebyshev polynomial that is small between ``lower`` and ``upper``,
    and, from the Lanczos column that rode along, a lower bound of the spectrum."""
    middle, half = (upper + lower) / 2, max((upper - lower) / 2, 1e-300)
    bound, old, new = None, q, None
    for _ in range(DEGREE):
        here = old if new is None else new
        rider = [lanczos.basis[-1][:, None]] if lanczos else []
        product = covariance @ np.hstack([here, *rider])
        if lanczos:
            if not lanczos.step(product[:, -1]):
                bound, lanczos = lanczos.lower(), None
            product = product[:, :-1] if rider else product
        shifted = (product - middle * here) / half
        old, new = here, shifted if new is None else 2 * shifted - old
        # One scale for all columns keeps the recurrence and the digits.
        scale = np.abs(new).max()
        if scale > 1e100:
            old, new = old / scale, new / scale
    if lanczos:
        bound = lanczos.lower()
    return new / np.linalg.norm(new, axis=0), None, bound


def _signed(vectors: np.ndarray) -> np.ndarray:
    """The same vectors with their entry of greatest size positive."""
    at = np.abs(vectors).argmax(axis=0)
    return vectors * np.where(vectors[at, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)


def fit(blocks: DataFrame, width: int, components: int = COMPONENTS) -> Fit | None:
    """Fit the packed vectors; None where there is none."""
    n, sums = _totals(blocks, width) if width else (0, np.zeros(0, np.int64))
    if not n:
        return None
    covariance = _Covariance(blocks, n, sums)
    trace = covariance.trace()
    values, vectors, residuals = leading(covariance, width, components)
    values = np.where(values > width * np.finfo(float).eps * max(trace, 0.0), values, 0.0)
    return Fit(n, sums, trace, values, vectors, residuals, covariance.passes)


def _projection(fitted: Fit) -> np.ndarray:
    """Columns that whiten a centred vector; components without variance give no number."""
    spread = np.sqrt(np.where(fitted.values > 0, fitted.values, np.nan))
    return fitted.vectors / spread


def identity_error(blocks: DataFrame, fitted: Fit) -> float | None:
    """The largest entry of the whitened covariance less the identity, over the fit list."""
    kept = fitted.values > 0
    if not kept.any():
        return None
    matrix, k = _projection(fitted)[:, kept], int(kept.sum())

    def moments(a: np.ndarray) -> np.ndarray:
        w = a @ matrix
        return np.vstack([w.sum(axis=0), w.T @ w])

    total = _summed(blocks, moments, fitted.n, fitted.sums).reshape(k + 1, k) / fitted.n
    return float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for every usable vector (``vec_id``, ``x``: longs) and component."""
    spark = vectors.sparkSession
    blocks, width = pack(vectors)
    fitted = fit(blocks, width, components)
    if fitted is None:
        return spark.createDataFrame([], WHITENED)
    error = identity_error(blocks, fitted)
    matrix, n, sums = _projection(fitted), fitted.n, fitted.sums
    explained = fitted.values / fitted.trace if fitted.trace > 0 else fitted.values * 0
    k = matrix.shape[1]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x, wide in zip(*(batch.column(c) for c in ("ids", "x", "wide"))):
                away = _deviations(x.as_py(), wide.as_py(), n, sums)
                count = len(away)
                whitened = ((away / n) @ matrix).ravel()
                deviation = np.array(_squares(away), dtype=object).repeat(k)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.array(ids.as_py(), dtype=object).repeat(k), pa.int64()),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                        pa.array(np.full(count * k, n, dtype=np.int64)),
                        pa.array(deviation, pa.int64()),
                        pa.array(whitened, mask=np.isnan(whitened)),
                        pa.array(np.tile(explained, count)),
                        pa.array([error] * (count * k), pa.float64()),
                    ],
                    names=[f.split(" ")[0] for f in WHITENED.split(", ")],
                )

    return blocks.select("ids", "x", "wide").mapInArrow(project, WHITENED)


def _squares(away: np.ndarray) -> list[int | None]:
    """The exact sum of squares of each row; None beyond a long."""
    most = (1 << 63) - 1
    if away.size == 0 or int(np.abs(away).max()) ** 2 * away.shape[1] <= most:
        return (away * away).sum(axis=1).tolist()
    exact = (away.astype(object) ** 2).sum(axis=1)
    return [int(v) if v <= most else None for v in exact]


def whole_entries(embedding: Column) -> Column:
    """Entries as floor(1024 c) + 100000; NULL for a vector with a missing or unusable entry."""
    entries = F.transform(embedding, lambda c: c.cast("double"))
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > F.lit(float(1 << 29))))
    whole = F.transform(entries, lambda c: (F.floor(F.lit(1024.0) * c) + 100000).cast("long"))
    return F.when(~bad, whole)
