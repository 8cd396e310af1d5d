"""Whitening of vectors by an incremental eigendecomposition.

Every task keeps the eigenpairs of what it has seen and takes in one centred row at a
time as a rank-one change: the new eigenvalues are the roots of a secular equation,
entries that change nothing are deflated first. Spectra of tasks are combined by
taking in one's eigenpairs into the other, one after another, in rounds of bounded
groups. A last pass over the rows makes the eigenvectors exact: the covariance is
projected on them and diagonalised again (Rayleigh-Ritz), with the residual checked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake.session import materialize

COMPONENTS = 8
# Spectra that one task combines.
GROUP_SPECTRA = 8
# Entries this large could overflow a sum of whole numbers; such vectors count as not finite.
LARGEST = 2.0**32
# Relative residual at which the refinement ends, and the passes it may take.
RESIDUAL = 1e-11
MOST_PASSES = 6

_EPS = np.finfo(float).eps
_SPECTRUM = "part long, vals array<double>, vecs array<double>"
_SUMS = "pos int, sums array<double>"
_WHITENED = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


@dataclass(frozen=True)
class Centre:
    """Count and exact per-dimension sums of the whole-number vectors."""

    n: int
    sums: tuple[int, ...]

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """What the mean is above ``whole``, times n."""
        return np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Per row the sum of ``(n * x - S) ** 2``, exactly; null where a long cannot hold it."""
        off, rest = x - self.whole, self.rest
        most = (int(np.abs(off).max(initial=0)) + 1) * self.n
        if most * most * x.shape[1] < 1 << 62:
            return ((self.n * off - rest) ** 2).sum(1).tolist()
        exact = (((self.n * off.astype(object)) - rest.astype(object)) ** 2).sum(1)
        return [v if v < 1 << 63 else None for v in exact.tolist()]


@dataclass(frozen=True)
class Whitening:
    """Components as columns, their eigenvalues, and the trace of the covariance."""

    centre: Centre
    components: np.ndarray
    values: np.ndarray
    trace: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.components / np.sqrt(self.values)


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``diag(d) + z z'`` for rising ``d`` and no zero in ``z``, and ``d[i] - root[j]``.

    Root j lies between ``d[j]`` and the next, the last below ``d[-1] + z'z``. All are
    found together, each as a distance from the nearer end, by interpolation with two
    poles and bisection where that leaves the bracket.
    """
    k = len(d)
    squares = z * z
    ends = np.append(d, d[-1] + squares.sum())
    gaps = np.diff(ends)
    half = gaps / 2
    at_half = 1 + (squares[:, None] / (d[:, None] - (d + half)[None, :])).sum(0)
    right = at_half < 0
    right[-1] = False
    origin = np.where(right, ends[1:], d)
    delta = d[:, None] - origin[None, :]
    low, high = np.where(right, -half, 0.0), np.where(right, 0.0, half)
    if at_half[-1] < 0:
        low[-1], high[-1] = half[-1], gaps[-1]
    tau = (low + high) / 2
    left_pole, right_pole = d - origin, ends[1:] - origin
    own = np.tri(k, dtype=bool).T  # [i, j]: pole i lies at or below root j
    for _ in range(80):
        between = delta - tau
        terms = squares[:, None] / between
        slopes = terms / between
        f = 1 + terms.sum(0)
        below = np.where(own, slopes, 0.0).sum(0)
        slope = slopes.sum(0)
        above = slope - below
        low, high = np.where(f < 0, tau, low), np.where(f < 0, high, tau)
        done = np.abs(f) <= 4 * _EPS * (1 + np.abs(terms).sum(0))
        done |= high - low <= 2 * _EPS * np.maximum(np.abs(low), np.abs(high))
        if done.all():
            break
        dl, dr = left_pole - tau, right_pole - tau
        a = (dl + dr) * f - dl * dr * slope
        b = dl * dr * f
        c = f - dl * below - dr * above
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        moved = tau + step
        inside = np.isfinite(moved) & (moved > low) & (moved < high)
        tau = np.where(done, tau, np.where(inside, moved, (low + high) / 2))
    return origin + tau, delta - tau


class Spectrum:
    """Eigenvalues, rising, and eigenvectors of a sum of rank-one terms."""

    def __init__(self, dim: int):
        self.vals, self.vecs = np.zeros(dim), np.eye(dim)

    def add(self, x: np.ndarray) -> None:
        """Takes in ``x x'``."""
        vals, vecs = self.vals, self.vecs
        z = x @ vecs
        length = np.sqrt(z @ z)
        tiny = 8 * _EPS * max(vals[-1], length * length)
        active = np.flatnonzero(np.abs(z) * length > tiny)
        if not len(active):
            return
        close = np.flatnonzero(np.diff(vals[active]) <= tiny)
        if len(close):
            active = self._deflate(z, active, tiny)
        d, z = vals[active], z[active]
        if len(active) == 1:
            vals[active] = d + z * z
        else:
            roots, between = secular_roots(d, z)
            # The z for which these roots are exact; with it the vectors are orthogonal.
            k = len(d)
            under = d[None, :] - d[:, None]
            under = np.where(np.tri(k, k, -1, dtype=bool), under, np.roll(under, -1, axis=1))
            under[:, -1] = 1.0
            fitted = np.sqrt(np.abs(np.prod(between / under, axis=1))) * np.sign(z)
            turned = fitted[:, None] / between
            turned /= np.sqrt((turned * turned).sum(0))
            vals[active] = roots
            vecs[:, active] = vecs[:, active] @ turned
        if (np.diff(vals) < 0).any():
            order = np.argsort(vals, kind="stable")
            self.vals, self.vecs = vals[order], vecs[:, order]

    def _deflate(self, z: np.ndarray, active: np.ndarray, tiny: float) -> np.ndarray:
        """Turns vectors of equal value so that one of them takes all the change."""
        kept = [active[0]]
        for j in active[1:]:
            i = kept[-1]
            if self.vals[j] - self.vals[i] <= tiny:
                both = np.hypot(z[i], z[j])
                c, s = z[j] / both, z[i] / both
                u, v = self.vecs[:, i].copy(), self.vecs[:, j].copy()
                self.vecs[:, i], self.vecs[:, j] = c * u - s * v, c * v + s * u
                z[i], z[j] = 0.0, both
                kept[-1] = j
            else:
                kept.append(j)
        return np.array(kept)

    def row(self, part: int) -> pa.RecordBatch:
        """Part and the eigenpairs that are not zero."""
        used = self.vals > 0
        columns = [
            pa.array([part], pa.int64()),
            pa.array([self.vals[used].tolist()], pa.list_(pa.float64())),
            pa.array([self.vecs[:, used].T.ravel().tolist()], pa.list_(pa.float64())),
        ]
        return pa.RecordBatch.from_arrays(columns, ["part", "vals", "vecs"])


def whole_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id, x`` with ``x = floor(1024 * c) + 100000``; vectors without a usable entry are left out."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("c"))
    usable = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    rows = rows.filter(F.col("c").isNotNull() & (F.size("c") > 0)).filter(usable)
    return rows.select("vec_id", F.transform("c", lambda c: F.floor(c * 1024) + 100_000).alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def centre_of(rows: DataFrame) -> Centre | None:
    """Count and sums over the vectors of the commonest dimension (the smallest of several); None without rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            lengths = batch.column("x").value_lengths().to_numpy()
            for dim in np.unique(lengths).tolist():
                x = _matrix(batch.filter(pa.array(lengths == dim)))
                counts[dim] = counts.get(dim, 0) + len(x)
                totals[dim] = totals.get(dim, 0) + x.sum(0).astype(object)
        out = [(dim, pos, counts[dim], str(s)) for dim, t in totals.items() for pos, s in enumerate(t.tolist())]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.string()]
        columns = [pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["dim", "pos", "n", "total"])

    parts = rows.mapInArrow(add, "dim int, pos int, n long, total string")
    summed = parts.groupBy("dim", "pos").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).cast("decimal(38,0)").alias("total")
    )
    summed = materialize(summed, "vector-sums")
    best = summed.filter("pos = 0").orderBy(F.desc("n"), "dim").first()
    if best is None:
        return None
    # One row per dimension of a vector.
    found = summed.filter(F.col("dim") == best["dim"]).orderBy("pos").collect()
    return Centre(best["n"], tuple(int(r["total"]) for r in found))


def spectrum_of(rows: DataFrame, centre: Centre) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors (columns) of the sum over all centred rows, nearly exact."""
    dim = len(centre.sums)

    def take_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum = Spectrum(dim)
        for batch in batches:
            for x in centre.centred(_matrix(batch)):
                spectrum.add(x)
        yield spectrum.row(TaskContext.get().partitionId())

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum, part = Spectrum(dim), 0
        for batch in batches:
            for own, vals, vecs in zip(*(batch.column(c) for c in ("part", "vals", "vecs"))):
                part = own.as_py() // GROUP_SPECTRA
                scales = np.sqrt(vals.values.to_numpy())
                for scaled in vecs.values.to_numpy().reshape(-1, dim) * scales[:, None]:
                    spectrum.add(scaled)
        yield spectrum.row(part)

    spectra = materialize(rows.mapInArrow(take_in, _SPECTRUM).filter("size(vals) > 0"), "spectra")
    while spectra.count() > 1:
        group = F.floor(F.col("part") / GROUP_SPECTRA).alias("group")
        spectra = materialize(spectra.groupBy(group).applyInArrow(combine, _SPECTRUM), "spectra")
    last = spectra.first()
    if last is None:
        return np.empty(0), np.empty((dim, 0))
    return np.array(last["vals"]), np.array(last["vecs"]).reshape(-1, dim).T


def _summed(rows: DataFrame, width: int, add) -> np.ndarray:
    """Sums over all rows of the matrix that ``add`` makes of a batch's vectors; it has ``width`` rows."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(add(_matrix(b)) for b in batches if b.num_rows)
        if isinstance(total, np.ndarray):
            columns = [pa.array(range(width), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["pos", "sums"])

    parts = rows.mapInArrow(partial, _SUMS)
    total = vector_to_array(Summarizer.sum(array_to_vector("sums")))
    found = parts.groupBy("pos").agg(total.alias("sums")).orderBy("pos").collect()
    return np.array([r["sums"] for r in found])


def refine(rows: DataFrame, centre: Centre, vecs: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Rayleigh-Ritz: falling eigenvalues, eigenvectors as columns and the covariance's trace.

    Each pass multiplies the covariance with the basis, without forming it. The basis
    has as many vectors as the covariance has rank, so one pass is exact up to rounding;
    further ones follow if the residual says otherwise.
    """
    basis, _ = np.linalg.qr(vecs)
    dim, rank = basis.shape

    def multiply(x: np.ndarray) -> np.ndarray:
        c = centre.centred(x)
        squares = np.zeros((1, rank))
        squares[0, 0] = (c * c).sum()
        return np.vstack([c.T @ (c @ basis), squares])

    for _ in range(MOST_PASSES):
        sums = _summed(rows, dim + 1, multiply) / centre.n
        image, trace = sums[:-1], float(sums[-1, 0])
        inner = basis.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        found = basis @ turn
        residual = np.abs(image @ turn - found * values).max()
        if residual <= RESIDUAL * values[0]:
            break
        basis, _ = np.linalg.qr(image @ turn)
    return values, found, trace


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all rows (vec_id, x); None where nothing varies.

    Components whose variance is within rounding of zero cannot be scaled and are left out.
    """
    centre = centre_of(rows)
    if centre is None:
        return None
    dim = len(centre.sums)
    own = rows.filter(F.size("x") == dim)
    vals, vecs = spectrum_of(own, centre)
    if not len(vals):
        return None
    values, found, trace = refine(own, centre, vecs)
    used = int((values[:components] > dim * _EPS * 16 * trace).sum())
    return Whitening(centre, found[:, :used], values[:used], trace)


def identity_error(rows: DataFrame, whitening: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k = len(whitening.values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = whitening(x)
        return np.vstack([w.T @ w, w.sum(0)])

    sums = _summed(rows, k + 1, moments) / whitening.centre.n
    return float(np.abs(sums[:-1] - np.outer(sums[-1], sums[-1]) - np.eye(k)).max())


def whiten(vectors: DataFrame, key: str, vector: str, components: int = COMPONENTS) -> DataFrame:
    """A row per usable vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Fitted on all usable vectors, repeated rows and null ids included. Vectors that are
    null, empty, hold a null, a non-finite entry or one of 2 ** 32 or more, or have another
    dimension than most, are left out. Components without variance have no rows, so an
    empty table or a single vector gives none. ``deviation`` is null where a long cannot
    hold it. Other columns are ignored.
    """
    rows = whole_vectors(vectors, key, vector)
    whitening = fit(rows, components)
    if whitening is None:
        return vectors.sparkSession.createDataFrame([], _WHITENED)
    rows = rows.filter(F.size("x") == len(whitening.centre.sums))
    error = identity_error(rows, whitening)
    k, n = len(whitening.values), whitening.centre.n
    explained = whitening.values / whitening.trace

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch) if batch.num_rows else np.empty((0, len(whitening.centre.sums)), np.int64)
            at = np.repeat(np.arange(len(x)), k)
            columns = [
                batch.column("vec_id").take(pa.array(at)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(at), n, np.int64)),
                pa.array(whitening.centre.deviations(x), pa.int64()).take(pa.array(at)),
                pa.array(whitening(x).ravel()),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(at), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _WHITENED.split(", ")])

    return rows.mapInArrow(apply, _WHITENED)
