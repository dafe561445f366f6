"""Whitening of embeddings by their leading principal components.

The components come from Chebyshev-filtered subspace iteration. A block of directions Q is multiplied by the covariance again and again,
each time by one distributed pass that sums XᵀXQ of the centred vectors X. The products make up a polynomial that stays small on the
unwanted part of the spectrum and grows beyond it; QR and Rayleigh-Ritz turn the filtered block into approximate eigenvectors, until their
residuals, and a last round with fresh random directions, certify them. What reaches the driver is of the dimension times the block's width.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.util import arrow_batches, stored

COMPONENTS = 32
#: Fixed values of the numbers that are whitened: long(floor(SCALE * entry)) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: An entry whose product with SCALE is not below this makes no exact long; its vector is left out as one with a non-finite entry is.
LARGEST = 2.0**53
#: Directions iterated beside the wanted ones, degree of the filter, and fresh directions in the last round.
GUARD, DEGREE, PROBES = 16, 8, 4
#: Residuals, as a share of the largest eigenvalue, at which components are taken; eigenvalues below this share count as zero.
RESIDUAL, RANK = 1e-13, 1e-11
#: A filter may grow the largest component so much more than the smallest; beyond, rounding would hide the small ones.
GROWTH = 1e8
#: Rounds before the guard is doubled; with a block as wide as the vectors no filter is needed.
ROUNDS = 12

_BLOCK = pa.schema([("d", pa.int32()), ("n", pa.int64()), ("kind", pa.string()), ("x", pa.binary()), ("sums", pa.list_(pa.decimal128(38, 0)))])


def _vectors(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length of vectors the rows that have one with finite entries, and floor(SCALE * entry) of these."""
    column = column.cast(pa.list_(pa.float64()))
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    for length in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == length)
        # A null entry comes as NaN.
        x = np.floor(SCALE * column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), length))
        good = (np.abs(x) < LARGEST).all(axis=1)
        if good.any():
            yield length, rows[good], x[good].astype(np.int64)


def blocks(vectors: DataFrame) -> DataFrame:
    """The numbers of finite vectors in matrices of one length: ``d``, ``n`` rows, the integer type and the bytes, and the sums by column."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for length, _, x in _vectors(batch.column(0)):
                kind = next(k for k in ("<i2", "<i4", "<i8") if k == "<i8" or np.abs(x).max() <= np.iinfo(k).max)
                exact = x.astype(object) if float(np.abs(x).max()) * len(x) > 2.0**62 else x
                rows.append((length, len(x), kind, x.astype(kind).tobytes(), [Decimal(int(s)) for s in exact.sum(axis=0)]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _BLOCK)], schema=_BLOCK)

    return vectors.select("embedding").mapInArrow(pack, "d int, n long, kind string, x binary, sums array<decimal(38,0)>")


class _Centred:
    """Passes over the blocks of one length. Vectors are centred before anything is multiplied: exactly by the whole part of the mean,
    then by its rest."""

    def __init__(self, packed: DataFrame, d: int):
        self.d, own = d, packed.where(F.col("d") == d)
        self.n = own.agg(F.sum("n")).first()[0]
        sums = {r["pos"]: int(r["s"]) for r in own.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s")).collect()}
        self.whole = np.array([sums[j] // self.n for j in range(d)], np.int64)
        self.left = [sums[j] % self.n for j in range(d)]
        self.rest = np.array([r / self.n for r in self.left])
        self.packed = own.select("kind", "x")
        self.passes = 0

    def summed(self, product: Callable[[np.ndarray], np.ndarray], rows: int, columns: int) -> np.ndarray:
        """The sum, over all blocks, of a matrix made from each; one pass. Tasks add up their own blocks first."""
        d, whole, rest = self.d, self.whole, self.rest

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for kind, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                    x = np.frombuffer(data.as_buffer(), kind).reshape(-1, d)
                    part = product((x - whole) - rest)
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows), pa.int32()), *(pa.array(c) for c in total.T)],
                                                 ["i", *(f"c{j}" for j in range(columns))])

        names = [f"c{j}" for j in range(columns)]
        parts = self.packed.mapInArrow(add, "i int, " + ", ".join(f"{c} double" for c in names))
        got = parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).toArrow().sort_by("i")
        self.passes += 1
        return np.column_stack([got[c].to_numpy() for c in names])

    def times(self, q: np.ndarray) -> np.ndarray:
        """The covariance times some directions."""
        return self.summed(lambda c: c.T @ (c @ q), self.d, q.shape[1]) / self.n

    def trace(self) -> float:
        return float(self.summed(lambda c: (c * c).sum(axis=0)[:, None], self.d, 1).sum() / self.n)


class _Lanczos:
    """A lower bound of the spectrum, from a vector that rides along in the passes of the first filter."""

    def __init__(self, start: np.ndarray):
        self.basis, self.a, self.b = [start / np.linalg.norm(start)], [], []

    def take(self, product: np.ndarray) -> None:
        self.a.append(self.basis[-1] @ product)
        for _ in range(2):
            for u in self.basis:
                product = product - (u @ product) * u
        self.b.append(np.linalg.norm(product))
        self.basis.append(product / max(self.b[-1], np.finfo(float).tiny))

    def low(self, cut: float) -> float:
        values, vectors = np.linalg.eigh(np.diag(self.a) + np.diag(self.b[:-1], 1) + np.diag(self.b[:-1], -1))
        return max(0.0, values[0] - self.b[-1] * abs(vectors[-1, 0]) - 0.02 * max(0.0, cut - values[0]))


def _ritz(q: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rayleigh-Ritz of a block and its product: values from the largest on, the rotated block and its product."""
    h = q.T @ y
    values, turn = np.linalg.eigh((h + h.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, y @ turn


def _filtered(data: _Centred, q: np.ndarray, y: np.ndarray, values: np.ndarray, locked: int, low: float, lanczos: _Lanczos | None) -> np.ndarray:
    """The block under a Chebyshev polynomial of the covariance that is small between ``low`` and the block's least value.

    Directions that have converged (the first ``locked``) stay, and are kept out of the others. ``y`` is the block's product.
    """
    high, cut = values[locked], values[-1]
    half, middle = max((cut - low) / 2, 1e-12 * high), (cut + low) / 2
    reach = max((high - middle) / half, 1 + 1e-12)
    degree = int(np.clip(np.log(2 * GROWTH) / np.arccosh(reach), 2, DEGREE))
    own, kept = slice(locked, None), q[:, :locked]
    sigma = first = 1 / reach
    before, now = q[:, own], (y[:, own] - middle * q[:, own]) * (first / half)
    for _ in range(degree - 1):
        now -= kept @ (kept.T @ now)
        product = data.times(now if lanczos is None else np.column_stack([now, lanczos.basis[-1]]))
        if lanczos is not None:
            lanczos.take(product[:, -1])
            product = product[:, :-1]
        following = 1 / (2 / first - sigma)
        before, now, sigma = now, 2 * following / half * (product - middle * now) - sigma * following * before, following
    return np.column_stack([kept, now])


def components(data: _Centred, wanted: int = COMPONENTS, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The leading eigenvalues, falling, and unit eigenvectors (columns) of the covariance; as many as are above zero, up to ``wanted``."""
    rng = np.random.default_rng(seed)
    d = data.d
    width, low, certified, rounds = min(d, wanted + GUARD), 0.0, False, 0
    lanczos: _Lanczos | None = _Lanczos(rng.standard_normal(d))
    q = np.linalg.qr(rng.standard_normal((d, width)))[0]
    y = data.times(q)
    while True:
        values, q, y = _ritz(q, y)
        if values[0] <= 0:
            return np.zeros(0), np.zeros((d, 0))
        residuals = np.linalg.norm(y - q * values, axis=0) / values[0]
        taken = min(wanted, int((values > RANK * values[0]).sum()))
        done = bool((residuals[:taken] <= RESIDUAL).all())
        if done and (certified or width == d or taken < wanted):
            return values[:taken], q[:, :taken]
        # A direction that all rounds missed would show in a round with fresh ones in place of the last guards.
        certified, rounds = done, rounds + 1
        if done:
            q[:, -PROBES:] = rng.standard_normal((d, min(PROBES, width)))
            q = np.linalg.qr(q)[0]
            y = data.times(q)
            values, q, y = _ritz(q, y)
            residuals = np.linalg.norm(y - q * values, axis=0) / values[0]
        elif rounds % ROUNDS == 0:
            extra = rng.standard_normal((d, min(d, 2 * width - wanted) - width))
            q = np.linalg.qr(np.column_stack([q, extra]))[0]
            width, y = q.shape[1], data.times(q)
            continue
        locked = min(int(np.argmax(residuals > RESIDUAL)) if (residuals > RESIDUAL).any() else wanted, wanted, width - 1)
        q = np.linalg.qr(_filtered(data, q, y, values, locked, low, lanczos))[0]
        if lanczos is not None and len(lanczos.a) > 1:
            low, lanczos = lanczos.low(values[-1]), None
        y = data.times(q)


def whiten(vectors: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """``vec_id`` of each vector with ``n``, ``deviation``, and by component ``whitened`` and ``explained``; and ``identity_error``.

    ``vectors`` needs ``vec_id`` and ``embedding`` (an array of floats or doubles); other columns, whatever their names, are left out. Null
    vectors and vectors with null, non-finite or too large entries (``LARGEST``) are left out. All others of the commonest length
    (of equally common ones, the longest) are the fit list; a vector of another length lacks entries and is left out too.
    Repeated rows, also with one id or none, count and come out each. Entries become long(floor(64 * entry)) + 1000000; ``n`` is
    the number of vectors, ``deviation`` the exact sum of (n * x - sum of x)² over the dimensions, ``whitened`` the centred vector
    along each component over the component's standard deviation, ``explained`` the share of the variance, and ``identity_error`` the
    largest difference of the whitened vectors' covariance and the identity. A component's sign is arbitrary but the same in all
    rows. Components without variance are left out, so equal vectors have none; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    arrow_batches(spark)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    packed = stored(blocks(vectors), "vectors")
    lengths = packed.groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    data = _Centred(packed, lengths["d"])
    values, directions = components(data, wanted)
    project = directions / np.sqrt(values)
    k, error, explained = len(values), 0.0, np.zeros(0)
    if k:
        found = data.summed(lambda c: (w := c @ project).T @ w, k, k) / data.n
        error, explained = float(np.abs(found - np.eye(k)).max()), values / data.trace()
    d, n, whole, rest, left = data.d, data.n, data.whole, data.rest, data.left

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remainder = np.array(left, np.int64)
        for batch in batches:
            for length, rows, x in _vectors(batch.column(1)):
                if length != d:
                    continue
                off = x - whole
                white = (off - rest) @ project
                largest = (float(np.abs(off).max()) + 1) * n
                z = n * off - remainder if largest**2 * d < 2.0**62 else n * off.astype(object) - remainder
                ends = pa.array(np.arange(len(rows) + 1) * k, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows)), pa.array(np.full(len(rows), n), pa.int64()),
                    pa.array([Decimal(int(v)) for v in (z * z).sum(axis=1)], pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(ends, pa.array(white.ravel())),
                    pa.ListArray.from_arrays(ends, pa.array(np.tile(explained, len(rows)))),
                    pa.array(np.full(len(rows), error))],
                    ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.select("vec_id", "embedding").mapInArrow(apply, schema)
