"""Whitening of vectors by an incremental eigendecomposition.

Entries become whole numbers (``floor(64 c) + 1000000``). Each task keeps a mean and a spectrum of its
rows. A block of rows is reduced by an orthogonal factorization to at most as many vectors as there are
dimensions, with the same scatter; every such vector, and the difference of the block's mean, is a
rank-one update of the spectrum: deflation of entries that it leaves alone and of equal eigenvalues, then
the secular equation. Spectra of tasks are combined the same way, each eigenvector of one being a
rank-one update of the other, ``FAN_IN`` at a time. One more pass over all rows, centred on the exact
mean, measures the scatter in the combined basis (Rayleigh-Ritz), which gives the components to double
precision; a last pass measures how far the whitened rows are from unit covariance.

Sums, counts and deviations are exact. Up to 32 components with an eigenvalue that is more than
rounding are returned, largest first; their signs make the greatest entry positive.

Defined results: a vector that is null, or has a null or non-finite entry, is dropped, and so is one of
another length than the most frequent (of equally frequent ones the least); null or repeated ids are
ordinary rows; if all vectors are equal, or none is left, there are no components and no rows; other
columns are not looked at. Entries beyond 2^40 and deviations beyond 2^63 are refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.stored import stored

COMPONENTS = 32
SCALE, ORIGIN = 64, 1_000_000
FAN_IN = 16
BLOCK_ROWS = 4096
_TINY = np.finfo(np.float64).eps


def secular_roots(poles: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(z2 / (poles - x)) = 0`` with rising, distinct poles and positive ``z2``.

    Returns the pole next to each root and the distance from it, which keeps close roots apart.
    """
    n = len(poles)
    at = np.arange(n)
    width = np.append(np.diff(poles), z2.sum())
    middle = 1 + (z2 / (poles[None, :] - poles[:, None] - width[:, None] / 2)).sum(axis=1)
    upper = (middle < 0) & (at < n - 1)
    origin = at + upper
    gaps = poles[None, :] - poles[origin][:, None]
    low = np.where(upper, -width / 2, 0.0)
    high = np.where(upper, 0.0, np.where(at < n - 1, width / 2, width))
    step = (low + high) / 2
    to_lower, to_upper = np.where(upper, -width, 0.0), np.where(upper, 0.0, width)
    left = at[None, :] <= at[:, None]
    for _ in range(200):
        apart = gaps - step[:, None]
        part = z2 / apart
        value = 1 + part.sum(axis=1)
        low, high = np.where(value < 0, step, low), np.where(value < 0, high, step)
        slope = part / apart
        below, above = np.where(left, slope, 0).sum(axis=1), np.where(left, 0, slope).sum(axis=1)
        near, far = to_lower - step, to_upper - step
        with np.errstate(all="ignore"):
            a = (near + far) * value - near * far * (below + above)
            b = near * far * value
            c = value - near * below - far * above
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            move = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            new = step + move
            new = np.where((new > low) & (new < high), new, (low + high) / 2)
        # A value within its own rounding cannot be improved on.
        exact = np.abs(value) <= 2 * _TINY * n * (1 + np.abs(part).sum(axis=1))
        done = exact | (np.abs(new - step) <= 2 * _TINY * np.abs(step)) | (new == low) | (new == high)
        step = np.where(exact | (new == low) | (new == high), step, new)
        if done.all():
            break
    return origin, step


class Spectrum:
    """Count, mean and eigendecomposition of the scatter (sum of centred squares) of some rows."""

    def __init__(self, dims: int):
        self.n, self.mean = 0, np.zeros(dims)
        self.values, self.vectors = np.zeros(dims), np.eye(dims)

    def update(self, vector: np.ndarray) -> None:
        """Add ``vector`` times its transpose to the scatter."""
        z = self.vectors.T @ vector
        scale = max(self.values[-1], float(z @ z))
        if scale == 0:
            return
        order = np.argsort(self.values, kind="stable")
        values, vectors, z = self.values[order], self.vectors[:, order], z[order]
        # Deflation: an equal eigenvalue's part is turned into its neighbour, a tiny one left alone.
        for i in np.flatnonzero(np.diff(values) <= 4 * _TINY * scale):
            length = np.hypot(z[i], z[i + 1])
            if length:
                c, s = z[i + 1] / length, z[i] / length
                turned = c * vectors[:, i] - s * vectors[:, i + 1]
                vectors[:, i + 1] = s * vectors[:, i] + c * vectors[:, i + 1]
                vectors[:, i], z[i], z[i + 1] = turned, 0.0, length
        active = np.flatnonzero(z * z > (4 * _TINY) ** 2 * scale)
        if len(active):
            poles, part = values[active], z[active]
            origin, step = secular_roots(poles, part * part)
            # Entries that make the computed roots exact keep the vectors orthogonal.
            apart = (poles[origin] - poles[:, None]) + step
            gaps = poles[None, :] - poles[:, None]
            np.fill_diagonal(gaps, 1.0)
            ratio = apart.copy()
            own = np.diagonal(apart).copy()
            np.fill_diagonal(ratio, 1.0)
            exact = np.sign(part) * np.sqrt(np.abs(own * np.prod(ratio / gaps, axis=1)))
            turn = exact[:, None] / -apart
            turn /= np.sqrt((turn * turn).sum(axis=0))
            vectors[:, active] = vectors[:, active] @ turn
            values[active] = poles[origin] + step
        order = np.argsort(values, kind="stable")
        self.values, self.vectors = values[order], vectors[:, order]

    def join(self, n: int, mean: np.ndarray, parts: np.ndarray) -> None:
        """Add ``n`` rows with this mean whose scatter is the sum of the squares of ``parts``."""
        if not n:
            return
        for part in parts:
            self.update(part)
        total = self.n + n
        if self.n:
            self.update((mean - self.mean) * np.sqrt(self.n * n / total))
        self.mean += (mean - self.mean) * (n / total)
        self.n = total

    def add_rows(self, rows: np.ndarray) -> None:
        mean = rows.mean(axis=0)
        centred = rows - mean
        self.join(len(rows), mean, np.linalg.qr(centred, "r") if len(rows) > rows.shape[1] else centred)

    def add(self, other: Spectrum) -> None:
        self.join(other.n, other.mean, (other.vectors * np.sqrt(np.maximum(other.values, 0))).T)

    def row(self) -> tuple:
        return self.n, self.mean.tolist(), self.values.tolist(), self.vectors.ravel().tolist()

    @classmethod
    def of_row(cls, n, mean, values, vectors) -> Spectrum:
        out = cls(len(mean))
        out.n, out.mean, out.values = n, np.array(mean), np.array(values)
        out.vectors = np.array(vectors).reshape(len(mean), len(mean))
        return out


_SPECTRUM = "n long, mean array<double>, values array<double>, vectors array<double>"
_KINDS = [pa.int64(), *[pa.list_(pa.float64())] * 3]


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """The rows that are fitted: ``id`` and ``x``, entries as whole numbers, all of one length."""
    finite = F.forall(
        vector_col,
        lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))),
    )
    x = F.transform(vector_col, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(ORIGIN).cast("long"))
    rows = vectors.filter(F.col(vector_col).isNotNull() & finite).select(F.col(id_col).alias("id"), x.alias("x"))
    length = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    return rows.filter(F.size("x") == (length[0] if length else 0))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def combined(rows: DataFrame, dims: int) -> Spectrum:
    """The spectrum of all rows (``x``), about ``ORIGIN``."""

    def packed(spectrum: Spectrum) -> pa.RecordBatch:
        columns = [pa.array([value], kind) for value, kind in zip(spectrum.row(), _KINDS)]
        return pa.RecordBatch.from_arrays(columns, ["n", "mean", "values", "vectors"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Spectrum(dims)
        for batch in batches:
            x = (_matrix(batch.column(0), dims) - ORIGIN).astype(np.float64)
            for low in range(0, len(x), BLOCK_ROWS):
                total.add_rows(x[low : low + BLOCK_ROWS])
        if total.n:
            yield packed(total)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Spectrum(dims)
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                total.add(Spectrum.of_row(*row))
        if total.n:
            yield packed(total)

    spectra = stored(rows.select("x").mapInArrow(fit, _SPECTRUM), "whitening-spectra")
    while (count := spectra.count()) > 1:
        spectra = stored(spectra.repartition(-(-count // FAN_IN)).mapInArrow(join, _SPECTRUM), "whitening-spectra")
    return Spectrum.of_row(*spectra.first())


def _summed(rows: DataFrame, function, size: int) -> np.ndarray:
    """The sum over tasks of the ``size`` by ``size`` matrices that ``function`` gives per batch."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            total += function(batch)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size)), pa.array(total.ravel())], ["at", "part"])

    parts = rows.select("x").mapInArrow(add, "at long, part double").groupBy("at").agg(F.sum("part"))
    out = np.zeros(size * size)
    for at, value in parts.collect():
        out[at] = value
    return out.reshape(size, size)


def whitened(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per vector and component, with the exact deviation and the measures of the fit."""
    kind = vectors.select(id_col).schema[0].dataType.simpleString()
    schema = (
        f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    rows = stored(whole_numbers(vectors, id_col, vector_col), "whitening-rows")
    first = rows.select(F.size("x")).first()
    if first is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dims = first[0]
    measured = rows.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(
        F.count("*").alias("n"), F.sum("x").alias("total"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    measured = sorted(measured.collect())
    n, sums = measured[0].n, np.array([row.total for row in measured], dtype=np.int64)
    widest = max(max(row.total - n * row.low, n * row.high - row.total) for row in measured)
    if dims * widest * widest >= 1 << 63 or n * max(abs(row.high) for row in measured) >= 1 << 62:
        raise ValueError("deviations of these vectors do not fit whole numbers of 64 bits")

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        """``n x - S``: exact."""
        return n * _matrix(batch.column(batch.schema.get_field_index("x")), dims) - sums

    basis = combined(rows, dims).vectors[:, ::-1]

    def scatter(batch):
        y = centred(batch) / n @ basis
        return y.T @ y

    ritz = _summed(rows, scatter, dims) / n
    # A second round in the better basis leaves only rounding off its diagonal.
    basis = basis @ np.linalg.eigh((ritz + ritz.T) / 2)[1][:, ::-1]
    basis, _ = np.linalg.qr(basis)
    ritz = _summed(rows, scatter, dims) / n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, basis = values[::-1], basis @ turn[:, ::-1]
    used = min(components, int((values > max(values[0], 0) * dims * 16 * _TINY).sum()))
    if not used:
        return vectors.sparkSession.createDataFrame([], schema)
    axes = basis[:, :used] * np.sign(basis[np.abs(basis[:, :used]).argmax(axis=0), np.arange(used)])
    axes, explained = axes / np.sqrt(values[:used]), values[:used] / values.sum()

    def identity(batch):
        y = centred(batch) / n @ axes
        return y.T @ y

    error = float(np.abs(_summed(rows, identity, used) / n - np.eye(used)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            exact = centred(batch)
            count, y = len(exact), exact / n @ axes
            which = np.repeat(np.arange(count), used)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(which)),
                    pa.array(np.tile(np.arange(1, used + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * used, n)),
                    pa.array((exact * exact).sum(axis=1)[which]),
                    pa.array(y.ravel()),
                    pa.array(np.tile(explained, count)),
                    pa.array(np.full(count * used, error)),
                ],
                [field.split()[0] for field in schema.split(", ")],
            )

    return rows.select("id", "x").mapInArrow(project, schema)
