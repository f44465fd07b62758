"""Whitening of embeddings by a bidiagonal qd solver.

Every component c counts as x = floor(1024 * c) + 100000. The covariance of x is never formed:

1. Sums. Tasks add up x per dimension in two halves of its bits, so n and S are exact.
2. Blockwise QR. Every task reduces its centred rows to one triangle R, block by block; the
   triangles of up to FAN tasks are reduced to one, and so on until one is left. R'R / n is the
   covariance, and R keeps the digits that forming R'R would lose.
3. Householder reflections turn R into an upper bidiagonal B.
4. dqds on the squares of B finds the squared singular values, the smallest first, each to high
   relative accuracy. A step that turns negative is taken back and its shift reduced.
5. Twisted factorisations of B'B - e give an eigenvector for each wanted value. Vectors of a group
   of close values are made orthogonal to each other, by inverse iteration where one vanishes.
6. Rows are projected in tasks, and the covariance of the result is measured once more.

Only d sums, one d x d triangle and k x k products reach the driver; d is the width of a vector.

Defined cases: rows whose vector is null or holds null or non-finite components do not take part;
an empty vector does. Vectors of unequal lengths are padded with components 0. Rows that share an
id, and rows without one, all count. A component 1024 * c beyond 2**61 counts as 2**61 of its sign. A
deviation beyond 64 bits is null. Directions without variance, as far as the digits of R tell (all of
them where all vectors are alike), have `explained` 0 and `whitened` null and stay out of `identity_error`, which is 0 if no
direction has any. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratastar.llm.common import Scratch, settle
from stratastar.llm.vectors import finite, matrix

COMPONENTS = 8
SCALE, BASE = 1024, 100_000
#: Rows reduced at once, and triangles that become one.
ROWS = 4096
FAN = 32
EPS = float(np.finfo(float).eps)
#: Eigenvalues nearer to each other than this share are one group.
CLOSE = 1e-3

# ---------------------------------------------------------------- bidiagonal solver


def bidiagonalised(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with U' r V bidiagonal, by Householder reflections."""
    a = np.array(r, float)
    d = a.shape[1]
    right = np.eye(d)
    for k in range(d):
        v = _reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= np.outer(v, 2 * (v @ a[k:, k:]))
        if k + 2 < d:
            v = _reflector(a[k, k + 1 :])
            if v is not None:
                a[k:, k + 1 :] -= np.outer(2 * (a[k:, k + 1 :] @ v), v)
                right[:, k + 1 :] -= np.outer(2 * (right[:, k + 1 :] @ v), v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """Unit vector v such that x - 2 v v'x has its first entry only."""
    most = np.abs(x).max(initial=0.0)
    if len(x) < 2 or not np.abs(x[1:]).max() > 0:
        return None
    v = x / most
    v[0] += np.copysign(np.linalg.norm(v), v[0])
    return v / np.linalg.norm(v)


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, float]:
    """One dqds transform: new q and e, the least d and the last d."""
    d = least = q[0] - shift
    qq, ee = [], []
    for e_k, q_next in zip(e, q[1:], strict=True):
        if d < 0:
            return qq, ee, d, 1.0  # an early failure says nothing on the last d
        new = d + e_k
        ratio = q_next / new if new > 0 else 0.0
        qq.append(new)
        ee.append(e_k * ratio)
        d = d * ratio - shift
        least = min(least, d)
    qq.append(d)
    return qq, ee, least, d


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling, by dqds."""
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    if not scale > 0:
        return np.zeros(len(diagonal))
    tolerance = (10 * EPS) ** 2
    found: list[float] = []
    blocks = [(((diagonal / scale) ** 2).tolist(), ((above / scale) ** 2).tolist(), 0.0)]
    while blocks:
        q, e, total = blocks.pop()
        for _ in range(60 + 60 * len(q)):
            n = len(q)
            if n == 1:
                found.append(total + q[0])
                break
            if n == 2:
                found += [total + x for x in _pair(q[0], e[0], q[1])]
                break
            cut = next((k for k in range(n - 2, -1, -1) if e[k] <= tolerance * (total + min(q[k], q[k + 1])) or e[k] < 1e-290), None)
            if cut is not None:
                blocks += [(q[: cut + 1], e[:cut], total), (q[cut + 1 :], e[cut + 1 :], total)]
                break
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]  # small values leave at the end
            shift = min(_pair(q[-2], e[-1], q[-1])[1], min(q))
            while True:
                qq, ee, least, last = _step(q, e, shift)
                if least >= 0:
                    break
                # A negative last d measures how much the shift was too large.
                shift = shift + last if last < 0 and least == last and shift + last > shift / 4 else shift / 4
                if shift < EPS * min(q[-1], total + q[-1]):
                    shift = 0.0
            q, e, total = qq, ee, total + shift
        else:
            raise ArithmeticError("dqds did not converge")
    return np.sort(np.array(found))[::-1] * scale**2


def _pair(q0: float, e0: float, q1: float) -> tuple[float, float]:
    """The two eigenvalues of a qd array of length two."""
    half = (q0 + e0 + q1) / 2
    if half == 0:
        return 0.0, 0.0
    # (q0 + e0 - q1)^2 + 4 e0 q1 is the discriminant without cancellation.
    large = half + np.sqrt((q0 + e0 - q1) ** 2 + 4 * e0 * q1) / 2
    return float(large), float(q0 / large * q1)


@dataclass(frozen=True)
class Bidiagonal:
    """B'B of an upper bidiagonal B, as L D L' with D the squares of the diagonal."""

    diagonal: np.ndarray
    above: np.ndarray

    @property
    def tiny(self) -> float:
        return EPS * EPS * max(float(np.abs(self.diagonal).max()), float(np.abs(self.above).max(initial=0.0))) ** 2

    def times(self, z: np.ndarray) -> np.ndarray:
        y = self.diagonal * z
        y[:-1] += self.above * z[1:]
        out = self.diagonal * y
        out[1:] += self.above * y[:-1]
        return out

    def twisted(self, value: float) -> np.ndarray:
        """Unit vector z with (B'B - value) z a multiple of one unit vector, the least such multiple."""
        n, tiny = len(self.diagonal), self.tiny
        d = np.maximum(self.diagonal**2, tiny)
        low = self.above * np.where(self.diagonal[:-1] < 0, -1, 1) / np.sqrt(d[:-1])
        dl, d_list, low_list = (d[:-1] * low).tolist(), d.tolist(), low.tolist()
        s, before, forward = -value, [], []
        for i in range(n):
            before.append(s)
            if i < n - 1:
                plus = d_list[i] + s
                plus = plus if abs(plus) > tiny * EPS else tiny * EPS
                forward.append(dl[i] / plus)
                s = forward[i] * low_list[i] * s - value
        p, after, backward = d_list[-1] - value, [0.0] * n, [0.0] * (n - 1)
        after[-1] = p
        for i in range(n - 2, -1, -1):
            minus = dl[i] * low_list[i] + p
            minus = minus if abs(minus) > tiny * EPS else tiny * EPS
            ratio = d_list[i] / minus
            backward[i] = low_list[i] * ratio
            p = p * ratio - value
            after[i] = p
        gamma = np.abs(np.array(before) + np.array(after) + value)
        at = int(np.argmin(np.where(np.isfinite(gamma), gamma, np.inf)))
        z = np.zeros(n)
        z[at] = 1.0
        for i in range(at - 1, -1, -1):
            z[i] = -forward[i] * z[i + 1]
            if abs(z[i]) > 1e100:
                z /= abs(z[i])
        for i in range(at, n - 1):
            z[i + 1] = -backward[i] * z[i]
            if abs(z[i + 1]) > 1e100:
                z /= abs(z[i + 1])
        return z / np.linalg.norm(z)

    def solved(self, value: float, right: np.ndarray) -> np.ndarray:
        """Solution of (B'B - value) z = right, by elimination with row exchanges."""
        n = len(right)
        main = self.diagonal**2
        main[1:] += self.above**2
        main -= value
        side = (self.diagonal[:-1] * self.above).tolist()
        rows = [[main[i], side[i] if i < n - 1 else 0.0, 0.0] for i in range(n)]
        z = right.tolist()
        for i in range(n - 1):
            below = [side[i], rows[i + 1][0], rows[i + 1][1]]
            if abs(below[0]) > abs(rows[i][0]):
                rows[i], below = below, rows[i]
                z[i], z[i + 1] = z[i + 1], z[i]
            pivot = rows[i][0] if rows[i][0] else self.tiny
            factor = below[0] / pivot
            rows[i + 1] = [below[1] - factor * rows[i][1], below[2] - factor * rows[i][2], 0.0]
            z[i + 1] -= factor * z[i]
        for i in range(n - 1, -1, -1):
            ahead = sum(rows[i][k] * z[i + k] for k in (1, 2) if i + k < n)
            pivot = rows[i][0] if abs(rows[i][0]) > self.tiny else self.tiny
            z[i] = (z[i] - ahead) / pivot
        return np.array(z)


def directions(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest squared singular values of a square r, all values' order, and their right vectors (columns)."""
    diagonal, above, right = bidiagonalised(r)
    values = squared_singular_values(diagonal, above)
    b = Bidiagonal(diagonal, above)
    wanted: list[np.ndarray] = []
    random = np.random.default_rng(1)
    k = min(k, int((values > values[0] * (64 * EPS * len(values)) ** 2).sum())) if len(values) and values[0] > 0 else 0
    first = 0
    for i in range(k):
        if i and values[i - 1] - values[i] > CLOSE * values[i - 1]:
            first = i
        z = b.twisted(values[i])
        near = np.array(wanted[first:i]).reshape(i - first, len(z))
        for turn in range(8):
            rest = z - near.T @ (near @ z)
            size = np.linalg.norm(rest)
            if turn and size > 0.5:
                z = rest / size
                break
            if size > 0.1:
                z = rest / size
                if not len(near):
                    break
                continue
            z = random.normal(size=len(z))
            for _ in range(3):
                z -= near.T @ (near @ z)
                z = b.solved(values[i] * (1 + EPS), z / np.linalg.norm(z))
                z /= np.linalg.norm(z)
        wanted.append(z)
    if not wanted:
        return np.zeros(0), np.zeros((len(values), 0))
    basis = np.linalg.qr(np.array(wanted).T)[0]
    return values[:k], right @ _aligned(b, basis, np.array(wanted).T, values[:k])


def _aligned(b: Bidiagonal, basis: np.ndarray, found: np.ndarray, values: np.ndarray) -> np.ndarray:
    """`basis` with the vectors of each group of close values turned so that B'B is diagonal on them.

    The matrices are as small as a group; Jacobi rotations diagonalise them.
    """
    out, first = basis.copy(), 0
    for end in range(1, len(values) + 1):
        if end < len(values) and values[end - 1] - values[end] <= CLOSE * values[end - 1]:
            continue
        group = basis[:, first:end]
        if end - first > 1:
            image = np.array([b.times(group[:, i]) for i in range(end - first)])
            group = group @ _rotations(image @ group)
            sizes = np.array([group[:, i] @ b.times(group[:, i]) for i in range(end - first)])
            group = group[:, np.argsort(-sizes, kind="stable")]
        out[:, first:end] = group
        first = end
    return out


def _rotations(a: np.ndarray, sweeps: int = 12) -> np.ndarray:
    a, n = (a + a.T) / 2, len(a)
    turned = np.eye(n)
    for _ in range(sweeps):
        for i in range(n - 1):
            for j in range(i + 1, n):
                if abs(a[i, j]) <= EPS * EPS * abs(a[i, i]):
                    continue
                theta = (a[j, j] - a[i, i]) / (2 * a[i, j])
                t = np.copysign(1, theta) / (abs(theta) + np.hypot(theta, 1)) if theta else 1.0
                c = 1 / np.hypot(t, 1)
                g = np.eye(n)
                g[i, i] = g[j, j] = c
                g[i, j], g[j, i] = c * t, -c * t
                a, turned = g.T @ a @ g, turned @ g
    return turned


# ---------------------------------------------------------------- rows in tasks


def entries(column: pa.Array, width: int) -> np.ndarray:
    """x of every component of a block of vectors."""
    with np.errstate(over="ignore"):
        scaled = np.floor(matrix(column, width) * SCALE)
    return np.clip(scaled, -(2.0**61), 2.0**61).astype(np.int64) + BASE


@dataclass(frozen=True)
class Centre:
    """n rows with exact sums `total`: mean = whole + rest / n, 0 <= rest < n."""

    n: int
    whole: tuple[int, ...]
    rest: tuple[int, ...]

    @staticmethod
    def of(n: int, total: list[int]) -> Centre:
        return Centre(n, tuple(s // n for s in total), tuple(s % n for s in total))

    def rows(self, x: np.ndarray) -> np.ndarray:
        """x less the mean; the difference of whole numbers is taken first and exactly."""
        return (x - np.array(self.whole, np.int64)).astype(float) - np.array([r / self.n for r in self.rest])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact; None beyond 64 bits."""
        u = x - np.array(self.whole, np.int64)
        most = float(np.abs(u.astype(float)).max(initial=0.0)) + 1
        if most * self.n < 2**31 and (most * self.n) ** 2 * max(1, x.shape[1]) < 2**62:
            scaled = u * self.n - np.array(self.rest, np.int64)
            return (scaled * scaled).sum(axis=1).tolist()
        exact = u.astype(object) * self.n - np.array(self.rest, object)
        return [s if s < 2**63 else None for s in (sum(v * v for v in row) for row in exact)]


def _sums(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    n, high, low = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
    for batch in batches:
        x = entries(batch.column(0), width)
        n += len(x)
        high += (x >> 32).sum(axis=0)
        low += (x & 0xFFFFFFFF).sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([high.tolist()]), pa.array([low.tolist()])], ["n", "high", "low"])


def _blocks(batches: Iterator[pa.RecordBatch], at: int, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for row in range(0, batch.num_rows, ROWS):
            part = batch.slice(row, ROWS)
            yield part, entries(part.column(at), width)


def _triangles(batches: Iterator[pa.RecordBatch], centre: Centre) -> Iterator[pa.RecordBatch]:
    width = len(centre.whole)
    r = np.zeros((0, width))
    for _, x in _blocks(batches, 0, width):
        r = np.linalg.qr(np.concatenate([r, centre.rows(x)]), mode="r")
    if len(r):
        yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])


def _joined(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    r = np.zeros((0, width))
    for batch in batches:
        for one in batch.column(0):
            r = np.linalg.qr(np.concatenate([r, np.frombuffer(one.as_py()).reshape(-1, width)]), mode="r")
    if len(r):
        yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])


def triangle(rows: DataFrame, centre: Centre, scratch: Scratch) -> np.ndarray:
    """R of the QR decomposition of all centred rows, d x d."""
    width = len(centre.whole)
    parts = scratch.store(rows.mapInArrow(lambda batches: _triangles(batches, centre), "r binary"), "triangles-0")
    turn, left = 0, parts.count()
    while left > 1:
        left = -(-left // FAN)
        turn += 1
        parts = scratch.store(parts.repartition(left).mapInArrow(lambda batches: _joined(batches, width), "r binary"), f"triangles-{turn}")
        scratch.drop(f"triangles-{turn - 1}")
        left = parts.count()
    found = parts.collect()  # one row
    scratch.drop(f"triangles-{turn}")
    r = np.zeros((width, width))
    if found:
        own = np.frombuffer(found[0]["r"]).reshape(-1, width)
        r[: len(own)] = own
    return r


def _products(batches: Iterator[pa.RecordBatch], centre: Centre, turn: np.ndarray) -> Iterator[pa.RecordBatch]:
    k = turn.shape[1]
    total, products = np.zeros(k), np.zeros((k, k))
    for _, x in _blocks(batches, 0, len(centre.whole)):
        y = centre.rows(x) @ turn
        total += y.sum(axis=0)
        products += y.T @ y
    yield pa.RecordBatch.from_arrays([pa.array([total.tolist()]), pa.array([products.ravel().tolist()])], ["total", "products"])


def _whitened(batches: Iterator[pa.RecordBatch], centre: Centre, turn: np.ndarray, explained: list[float], error: float) -> Iterator[pa.RecordBatch]:
    k, found = len(explained), turn.shape[1]
    for part, x in _blocks(batches, 1, len(centre.whole)):
        m = len(x)
        y = np.zeros((m, k))
        y[:, :found] = centre.rows(x) @ turn
        absent = np.tile(np.arange(k) >= found, m)
        deviation = pa.array(centre.deviations(x), pa.int64())
        each = pa.array(np.repeat(np.arange(m), k))
        columns = [
            part.column(0).take(each),
            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
            pa.array(np.full(m * k, centre.n)),
            deviation.take(each),
            pa.array(y.ravel(), mask=absent),
            pa.array(np.tile(explained, m)),
            pa.array(np.full(m * k, error)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def _added(rows: DataFrame, name: str) -> DataFrame:
    """Entry by entry sums of a list column; lists meet by position, after a sum in each map task."""
    return rows.select(F.posexplode(name).alias("pos", name)).groupBy("pos")


# ---------------------------------------------------------------- operator


@dataclass(frozen=True)
class Whitening:
    """The fitted transform: y = (x - mean) @ turn. `explained` has one share per component, 0 for those without variance."""

    centre: Centre
    turn: np.ndarray
    explained: list[float]
    identity_error: float


def fit(embeddings: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """Whitening of all vectors that take part; None if there are none or they have no components."""
    spark = settle(embeddings.sparkSession)
    scratch = Scratch(spark, "whitening")
    rows = _rows(embeddings).select("vector")
    width = rows.agg(F.max(F.size("vector"))).first()[0]
    if not width:
        return None
    sums = scratch.store(rows.mapInArrow(lambda batches: _sums(batches, width), "n long, high array<long>, low array<long>"), "sums")
    n = sums.agg(F.sum("n")).first()[0]
    exact = {name: {r["pos"]: int(r["s"]) for r in _added(sums, name).agg(F.sum(F.col(name).cast("decimal(38,0)")).alias("s")).collect()} for name in ("high", "low")}
    scratch.drop("sums")
    centre = Centre.of(n, [(exact["high"][i] << 32) + exact["low"][i] for i in range(width)])
    r = triangle(rows, centre, scratch)
    values, vectors = directions(r, k)
    trace = float((r * r).sum())
    explained = [float(v) / trace for v in values] + [0.0] * (min(k, width) - len(values))
    turn = vectors / np.sqrt(values / n)
    error = 0.0
    if len(values):
        schema = "total array<double>, products array<double>"
        parts = scratch.store(rows.mapInArrow(lambda batches: _products(batches, centre, turn), schema), "products")
        got = {name: {r["pos"]: r["s"] for r in _added(parts, name).agg(F.sum(name).alias("s")).collect()} for name in ("total", "products")}
        scratch.drop("products")
        mean = np.array([got["total"][i] for i in range(len(values))]) / n
        products = np.array([got["products"][i] for i in range(len(values) ** 2)]).reshape(len(values), -1)
        error = float(np.abs(products / n - np.outer(mean, mean) - np.eye(len(values))).max())
    return Whitening(centre, turn, explained, error)


def _rows(embeddings: DataFrame) -> DataFrame:
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    return rows.where(F.col("vector").isNotNull() & finite(F.col("vector")))


def whitened(embeddings: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    found = fit(embeddings, k)
    if found is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    return _rows(embeddings).mapInArrow(lambda batches: _whitened(batches, found.centre, found.turn, found.explained, found.identity_error), schema)
