"""Whitening of vectors along the leading principal components, found by Jacobi-Davidson.

The covariance is never formed. What the solver needs is its product with a few directions at once: one pass over the vectors, in which each
task centres its rows, multiplies, and returns one small matrix. The driver keeps a search space of ``SPACE`` times the wanted directions:

1. Rayleigh-Ritz in the search space gives values, vectors and residuals.
2. Pairs whose residual is down to double precision are locked, leading ones first, and leave the space.
3. For the others the correction equation (I - QQ')(V - theta)(I - QQ') t = -r, Q the locked and current vectors, is solved by some steps of MINRES,
   all equations sharing each pass; the corrections extend the space.

It ends when all wanted pairs are locked, no value left in the space exceeds them, and their residuals, computed afresh, hold.

Components become integers first (``floor(scale * c) + shift``), so that counts and sums are exact; rows are centred by the exact mean
before anything is multiplied. Scale: integers are written once, in blocks; a pass reads them and sends (dimensions x directions) doubles a task, added in
groups of tasks before the driver adds at most ``PARTS`` of them. Nothing else reaches the driver, nothing is shuffled.

Vectors that are null, empty, or hold null or non-finite components (or ones of 2^52 / scale and more) take no part, nor do those of another
dimension than the commonest (the smaller of two equally common). Null and repeated ids are rows of their own. Other columns are ignored. A component without
variance (rank too low, a single row, equal rows) has a null ``whitened``; ``explained`` is null without any variance; a ``deviation`` beyond a
long is null. An empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechtable import settings

#: Directions sought beside the wanted ones, steps of MINRES, and the search space in wanted directions.
GUARD, INNER, SPACE = 2, 5, 6
#: Matrices the driver adds itself.
PARTS = 64
#: Vectors in a block.
BLOCK = 4096
_EPS = float(np.finfo(np.float64).eps)
Product = Callable[[np.ndarray], np.ndarray]


@dataclass
class Fit:
    """Exact sums of the integer vectors (without the shift), and the components."""

    dims: int
    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float | None = None
    passes: int = 0
    residual: float = 0.0

    def centre(self, x: np.ndarray) -> np.ndarray:
        """Integer rows less the mean, in doubles."""
        whole, rest = _mean(self.sums, self.n)
        return (x - whole).astype(np.float64) - rest

    def usable(self) -> np.ndarray:
        """Components with variance."""
        return self.values > 64 * _EPS * self.dims * max(float(self.values[0]), 0.0) if len(self.values) else np.zeros(0, bool)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        good = self.usable()
        return self.centre(x) @ self.vectors[:, good] / np.sqrt(self.values[good])

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sums over dimensions of (n*x - S)^2."""
        whole, _ = _mean(self.sums, self.n)
        rest = np.array([s - int(m) * self.n for s, m in zip(self.sums, whole.tolist())], object)
        far = x - whole
        most = float(np.abs(far).max(initial=0)) * self.n + self.n
        if most * most * self.dims < 2.0**62:
            exact = far * self.n - rest.astype(np.int64)
            return (exact * exact).sum(1).tolist()
        found = ((far.astype(object) * self.n - rest) ** 2).sum(1)
        return [int(v) if v < 1 << 63 else None for v in found]


def _mean(sums: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole part and rest of the mean."""
    whole = np.array([s // n for s in sums], np.int64)
    return whole, np.array([float(Fraction(s % n, n)) for s in sums])


def rows_of(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """id, x of the vectors that can take part."""
    x = F.col("x")
    far = F.lit(2.0**52 / scale)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < far))
    return rows.where(x.isNotNull() & (F.size(x) > 0) & F.coalesce(good, F.lit(False)))


def whiten(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    rows = rows_of(vectors, id_col, vector_col, scale)
    kind = rows.schema["id"].dataType.simpleString()
    columns = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    common = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if common is None:
        return vectors.sparkSession.createDataFrame([], columns)
    rows = rows.where(F.size("x") == common["dims"])
    made = fit(rows, common["dims"], components, scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, good = len(made.values), made.usable()
        explained = [float(v) / made.trace if made.trace else None for v in made.values]
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = _integers(part.column(1), made.dims, scale)
                n = len(x)
                white = np.full((n, k), np.nan)
                white[:, good] = made.whiten(x)
                missing = np.tile(~good, n)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(np.repeat(np.arange(n), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * k, made.n, np.int64)), pa.array(made.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(n), k))),
                    pa.array(white.ravel(), pa.float64(), mask=missing), pa.array(explained * n, pa.float64()),
                    pa.array([made.identity_error] * (n * k), pa.float64())],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, columns)


def _integers(lists: pa.Array, dims: int, scale: int) -> np.ndarray:
    ends = lists.offsets.to_numpy()
    return np.floor(scale * lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]).astype(np.int64).reshape(-1, dims)


def fit(rows: DataFrame, dims: int, components: int, scale: int) -> Fit:
    """The leading components of all rows (id, x), which have one dimension."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                x = _integers(batch.column(0).slice(at, BLOCK), dims, scale)
                wide = bool(np.abs(x).max(initial=0) >= 1 << 31)
                yield pa.RecordBatch.from_arrays([pa.array([wide]), pa.array([x.astype("<i8" if wide else "<i4").tobytes()], pa.binary())], ["wide", "x"])

    table = settings.materialize(rows.select("x").mapInArrow(blocks, "wide boolean, x binary"), "vectors")
    tasks = table.rdd.getNumPartitions()

    def moments(parts: list[np.ndarray]) -> bytes:
        n, sums, squares = 0, [0] * dims, 0
        for x in parts:
            small = np.abs(x).max(initial=0) < 1 << 25
            y = x if small else x.astype(object)
            n += len(x)
            sums = [a + int(b) for a, b in zip(sums, y.sum(0))]
            squares += int((y * y).sum())
        return json.dumps([n, sums, squares]).encode()

    found = [json.loads(part) for part in _parts(table, dims, tasks, moments, _add_moments)]
    n, sums, squares = (sum(f[0] for f in found), [sum(s) for s in zip(*(f[1] for f in found))], sum(f[2] for f in found))
    trace = float(Fraction(n * squares - sum(s * s for s in sums), n * n))
    made = Fit(dims, n, sums, trace, np.zeros(0), np.zeros((dims, 0)))

    def product(u: np.ndarray) -> np.ndarray:
        made.passes += 1
        u = np.ascontiguousarray(u)

        def run(blocks: Iterator[np.ndarray]) -> bytes:
            out = np.zeros(u.shape)
            for x in blocks:
                y = made.centre(x)
                out += y.T @ (y @ u)
            return out.tobytes()

        parts = _parts(table, dims, tasks, run, _add_doubles)
        return np.frombuffer(_add_doubles(parts)).reshape(u.shape) / n

    made.values, made.vectors, made.residual = leading(product, dims, min(components, dims))
    good = made.usable()

    def squares_of(blocks: Iterator[np.ndarray]) -> bytes:
        k = int(good.sum())
        out = np.zeros((k + 1, k))
        for x in blocks:
            w = made.whiten(x)
            out[0] += w.sum(0)
            out[1:] += w.T @ w
        return out.tobytes()

    if good.any():
        k = int(good.sum())
        sums_of = np.frombuffer(_add_doubles(_parts(table, dims, tasks, squares_of, _add_doubles))).reshape(k + 1, k) / n
        made.identity_error = float(np.abs(sums_of[1:] - np.outer(sums_of[0], sums_of[0]) - np.eye(k)).max())
    return made


def _add_doubles(parts: list[bytes]) -> bytes:
    return np.sum([np.frombuffer(p) for p in parts], axis=0).tobytes()


def _add_moments(parts: list[bytes]) -> bytes:
    found = [json.loads(p) for p in parts]
    return json.dumps([sum(f[0] for f in found), [sum(s) for s in zip(*(f[1] for f in found))], sum(f[2] for f in found)]).encode()


def _parts(table: DataFrame, dims: int, tasks: int, run, add: Callable[[list[bytes]], bytes]) -> list[bytes]:
    """What ``run`` makes of the blocks of each task, added up to at most ``PARTS`` results, in an order that retries do not change."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[np.ndarray]:
            for batch in batches:
                for wide, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                    yield np.frombuffer(x.as_buffer(), "<i8" if wide else "<i4").reshape(-1, dims).astype(np.int64)

        made = run(blocks())
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([made], pa.binary())], ["task", "part"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted((t, p) for batch in batches for t, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([held[0][0]], pa.int32()), pa.array([add([p for _, p in held])], pa.binary())], ["task", "part"])

    made = table.mapInArrow(each, "task int, part binary")
    if tasks > PARTS:
        group = F.floor(F.col("task") / -(-tasks // PARTS))
        made = made.repartition(PARTS, group).mapInArrow(sums, "task int, part binary")
    return [r["part"] for r in sorted(made.collect(), key=lambda r: r["task"])]


def leading(product: Product, d: int, k: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray, float]:
    """(values by fall, unit vectors as columns, greatest residual) of the k leading eigenpairs of a symmetric product."""
    width = min(d, k + GUARD)
    locked, values = np.zeros((d, 0)), np.zeros(0)
    space = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, width)))[0]
    image = product(space)
    best, idle = np.inf, 0
    while True:
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        residual = image - space * theta
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        scale = max(float(np.abs(theta).max(initial=0)), float(np.abs(values).max(initial=0)))
        # Down to rounding; also where the space is all there is, or where further work no longer helps at that level.
        whole = locked.shape[1] + space.shape[1] >= d
        wanted = size[: max(k - len(values), 1)].max(initial=0)
        best, idle = (wanted, 0) if wanted < best / 2 else (best, idle + 1)
        enough = 16 * _EPS * np.sqrt(d) * scale
        if whole or (idle >= 6 and wanted <= 1e-12 * scale):
            enough = np.inf
        n = 0
        while n < len(theta) and len(values) + n < k and size[n] <= enough:
            n += 1
        while n < len(theta) and len(values) + n >= k and theta[n] > min(values.min(initial=np.inf), theta[:n].min(initial=np.inf)) and size[n] <= enough:
            n += 1
        if n:
            locked, values = np.hstack([locked, space[:, :n]]), np.concatenate([values, theta[:n]])
            space, image, theta, residual = space[:, n:], image[:, n:], theta[n:], residual[:, n:]
            best, idle = np.inf, 0
        if len(values) >= k and not (len(theta) and theta[0] > np.sort(values)[::-1][k - 1]):
            break
        if space.shape[1] + width > SPACE * width:
            space, image = space[:, : 2 * width], image[:, : 2 * width]
        aim = min(width, space.shape[1])
        q = np.hstack([locked, space[:, :aim]])
        extra = _independent(_corrections(product, q, theta[:aim], -residual[:, :aim]), np.hstack([locked, space]))
        if not extra.shape[1]:
            rng = np.random.default_rng(seed + space.shape[1] + len(values))
            extra = _independent(rng.standard_normal((d, width)), np.hstack([locked, space]))
        space, image = np.hstack([space, extra]), np.hstack([image, product(extra)])
    # Once more among the locked vectors, with a fresh product.
    order = np.argsort(-values, kind="stable")[:k]
    q = np.linalg.qr(locked[:, order])[0]
    image = product(q)
    small = q.T @ image
    theta, turn = np.linalg.eigh((small + small.T) / 2)
    theta, turn = theta[::-1], turn[:, ::-1]
    vectors = q @ turn
    residual = float(np.linalg.norm(image @ turn - vectors * theta, axis=0).max(initial=0))
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(k)])
    return np.maximum(theta, 0.0), vectors * signs, residual


def _independent(given: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Orthonormal columns that extend the known ones; what they already span is left out."""
    out = known
    for column in given.T:
        size = np.linalg.norm(column)
        if not size or out.shape[1] >= len(column):
            continue
        column = column / size
        for _ in range(3):
            column = column - out @ (out.T @ column)
            left = np.linalg.norm(column)
            if left < 1e-10:
                break
            column = column / left
        else:
            out = np.hstack([out, column[:, None]])
    return out[:, known.shape[1] :]


def _corrections(product: Product, q: np.ndarray, theta: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Some steps of MINRES on (I - QQ')(V - theta)(I - QQ') t = right, a column for each theta."""

    def away(x: np.ndarray) -> np.ndarray:
        return x - q @ (q.T @ x)

    right = away(right)
    beta = np.linalg.norm(right, axis=0)
    live = beta > 0
    x = np.zeros_like(right)
    if not live.any():
        return x
    theta, right, beta = theta[live], right[:, live], beta[live]
    v, before = right / beta, np.zeros_like(right)
    w, w_before = np.zeros_like(right), np.zeros_like(right)
    eta, back = beta.copy(), np.zeros_like(beta)
    c, c_before, s, s_before = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    found = np.zeros_like(right)
    for _ in range(INNER):
        z = away(product(v) - v * theta)
        alpha = (v * z).sum(0)
        z = away(z - alpha * v - back * before)
        ahead = np.linalg.norm(z, axis=0)
        delta = c * alpha - c_before * s * back
        rho = np.hypot(delta, ahead)
        rho = np.where(rho > 0, rho, np.inf)
        second, third = s * alpha + c_before * c * back, s_before * back
        c_before, c, s_before, s = c, delta / rho, s, ahead / rho
        w, w_before = (v - third * w_before - second * w) / rho, w
        found += c * eta * w
        eta = -s * eta
        before, v, back = v, z / np.where(ahead > 0, ahead, 1.0), ahead
    x[:, live] = found
    return x

