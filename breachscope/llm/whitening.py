"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The fit list (each distinct vector once) is centred and bidiagonalised: products of
the rows with a direction v, and of the columns with the result u, alternate until
every direction is found or no direction that is missing could matter. Both sides
are orthogonalised in full against all earlier vectors. Only the directions v and the small
bidiagonal matrix live on the driver; their size depends on the number of dimensions
alone. The entries of u belong to rows and stay with them: a row's entries follow
from the row and the bidiagonal by a short forward recurrence, so each step is one
pass over the stored fit list that returns sums over the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachscope.session import settle

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16

# Parts of the largest singular value below which a value counts as none.
_NOTHING = 1e-11
# Below this part of the whole a new direction is rounding only.
_BROKEN = 1e-13
_EXACT = 1 << 62


@dataclass(frozen=True)
class Whitening:
    """``directions`` has one component per column, by falling variance."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float = 0.0


def usable(vector: Column) -> Column:
    """Not null, and every entry a finite number."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def whole(vector: Column) -> Column:
    """``floor(64 c) + 1000000`` of every entry."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT).cast("bigint"))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _differences(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n x - sums``, exact; whole numbers of any size where 64 bits do not do."""
    if n * max(int(np.abs(x).max(initial=0)), 1) < _EXACT:
        return x * n - sums
    return x.astype(object) * n - sums.astype(object)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (_differences(x, n, sums) / n).astype(np.float64, copy=False)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    off = _differences(x, n, sums)
    if int(np.abs(off).max(initial=0)) ** 2 * max(x.shape[1], 1) >= _EXACT:
        off = off.astype(object)
    return (off * off).sum(axis=1).tolist()


def _sums(points: DataFrame, part: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum of ``part`` over all blocks of rows: one short vector, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = part(_matrix(batch.column(0)))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "v"]
            )

    rows = points.select("x").mapInArrow(run, f"i int, v {kind}").groupBy("i").agg(F.sum("v").alias("v")).collect()
    return np.array([v for _, v in sorted((r["i"], r["v"]) for r in rows)])


class _Bidiagonal:
    """What the driver keeps of the bidiagonalisation: directions ``v``, the products
    of the columns with each ``u``, and the entries of the small matrix."""

    def __init__(self, width: int):
        self.rng = np.random.default_rng(13)
        self.width = width
        self.v = np.zeros((width, 0))
        self.back = np.zeros((width, 0))  # X'u of each step
        self.alpha: list[float] = []
        self.beta: list[float] = [0.0]  # beta[j] couples v[j] with u[j - 1]
        self.spill: list[np.ndarray] = []  # what orthogonalisation took out of u[j]

    def _orthogonal(self, r: np.ndarray) -> np.ndarray:
        for _ in range(2):
            r = r - self.v @ (self.v.T @ r)
        return r

    def open(self, r: np.ndarray, whole: float) -> None:
        """The next direction: ``r`` made orthogonal to all before it, or a new random
        one, without coupling, where nothing of ``r`` is left."""
        r = self._orthogonal(r)
        size = float(np.linalg.norm(r))
        coupled = size > _BROKEN * whole and self.v.shape[1] > 0
        if not coupled:
            r = self._orthogonal(self._orthogonal(self.rng.standard_normal(self.width)))
        self.v = np.column_stack((self.v, r / np.linalg.norm(r)))
        if self.v.shape[1] > 1:
            self.beta.append(size if coupled else 0.0)

    def rows_part(self) -> Callable[[np.ndarray], np.ndarray]:
        """For centred rows: their part of ``p'p``, ``U'p`` and ``X'p``, where ``p`` is the
        product with the last direction, less its coupling."""
        v, alpha, beta, spill = self.v, list(self.alpha), list(self.beta), list(self.spill)

        def part(c: np.ndarray) -> np.ndarray:
            p = np.asfortranarray(c @ v)
            u = np.zeros((len(c), len(alpha)), order="F")
            for j in range(len(alpha) + 1):
                if j:
                    p[:, j] -= beta[j] * u[:, j - 1]
                if j == len(alpha):
                    break
                if alpha[j]:
                    u[:, j] = (p[:, j] - u[:, :j] @ spill[j]) / alpha[j]
            last = p[:, -1]
            return np.concatenate(([last @ last], u.T @ last, c.T @ last))

        return part

    def close(self, found: np.ndarray, whole: float) -> np.ndarray:
        """Take in the sums over the rows; returns what is left for the next direction."""
        j = len(self.alpha)
        square, spill, product = found[0], found[1 : 1 + j], found[1 + j :]
        alpha = float(np.sqrt(max(square - spill @ spill, 0.0)))
        alpha = alpha if alpha > _BROKEN * whole else 0.0
        back = (product - self.back @ spill) / alpha if alpha else np.zeros(self.width)
        self.alpha.append(alpha)
        self.spill.append(spill)
        self.back = np.column_stack((self.back, back))
        return back - alpha * self.v[:, -1]

    def solved(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Left vectors and values of the small matrix, and the directions they give."""
        j = len(self.alpha)
        small = np.diag(self.alpha) + np.diag(self.beta[1:j], 1)
        left, values, right = np.linalg.svd(small)
        return left, values, self.v[:, :j] @ right.T


def _directions(points: DataFrame, n: int, sums: np.ndarray, energy: float, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and right vectors of the centred rows, largest first."""
    width, whole = len(sums), float(np.sqrt(energy))
    state = _Bidiagonal(width)
    rest = np.zeros(width)
    seen = 0.0
    for step in range(1, width + 1):
        state.open(rest, whole)
        part = state.rows_part()
        rest = state.close(_sums(points, lambda x, part=part: part(_centred(x, n, sums))), whole)
        seen += state.alpha[-1] ** 2 + state.beta[step - 1] ** 2
        if step <= wanted:
            continue
        left, values, _ = state.solved()
        # Converged, and the part not seen yet is smaller than the least value wanted:
        # a direction that has been missed (of a multiple value, say) cannot matter.
        error = np.linalg.norm(state._orthogonal(rest)) * np.abs(left[-1, :wanted]).max()
        if error <= 1e-15 * values[0] and energy - seen < 0.5 * values[wanted - 1] ** 2:
            break
    _, values, directions = state.solved()
    return values, directions


def fit(rows: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Components of the distinct vectors of ``rows``; None if no row is usable.

    Rows whose vector is null, empty, or has a null or non-finite entry are left out;
    vectors of different lengths, or an entry whose whole number passes 64 bits, fail
    the job. Components without variance are none: fewer distinct vectors or constant
    dimensions give fewer components.
    """
    vector = F.col(vec_col)
    points = settle(
        rows.where(usable(vector) & (F.size(vector) > 0)).select(whole(vector).alias("x")).distinct()
    )
    n, least, most = points.agg(F.count(F.lit(1)), F.min(F.size("x")), F.max(F.size("x"))).first()
    if not n:
        return None
    if least != most:
        raise ValueError(f"vectors of {least} to {most} entries")
    sums = _sums(points, lambda x: x.sum(axis=0), "long")
    energy = float(_sums(points, lambda x: np.array([np.square(_centred(x, n, sums)).sum()]))[0])
    wanted = min(components, least)
    if energy == 0:
        return Whitening(n, sums, np.zeros((least, 0)), np.zeros(0), 0.0)
    values, directions = _directions(points, n, sums, energy, wanted)
    wanted = min(wanted, int((values > _NOTHING * values[0]).sum()))
    kept = np.ascontiguousarray(directions[:, :wanted])
    model = Whitening(n, sums, kept, values[:wanted] ** 2 / n, energy / n)
    return Whitening(n, sums, kept, model.variances, model.trace, _identity_error(points, model))


def _whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    return _centred(x, model.n, model.sums) @ model.directions / np.sqrt(model.variances)


def _identity_error(points: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance, less the identity."""
    k = len(model.variances)
    means = _sums(points, lambda x: _whitened(x, model).sum(axis=0)) / model.n

    def squares(x: np.ndarray) -> np.ndarray:
        off = _whitened(x, model) - means
        return (off.T @ off).ravel()

    return float(np.abs(_sums(points, squares).reshape(k, k) / model.n - np.eye(k)).max())


def whiten(
    rows: DataFrame, model: Whitening | None, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """One row for each usable row and component: ``vec_id, component, n, deviation,
    whitened, explained, identity_error``.

    Rows with a null id keep it; repeated rows give repeated results. Rows that ``fit``
    leaves out, and rows of a fit list of one vector, which has no component, give
    none.
    """
    fields = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    if model is None:
        return rows.sparkSession.createDataFrame([], fields)
    k = len(model.variances)
    explained = model.variances / model.trace if model.trace else model.variances

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m or not k:
                continue
            x = _matrix(batch.column(1))
            spread = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(spread)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)),
                    pa.array(_deviations(x, model.n, model.sums), pa.int64()).take(pa.array(spread)),
                    pa.array(_whitened(x, model).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, model.identity_error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    vector = F.col(vec_col)
    return (
        rows.where(usable(vector) & (F.size(vector) > 0))
        .select(F.col(id_col).cast("bigint").alias("vec_id"), whole(vector).alias("x"))
        .mapInArrow(project, fields)
    )
