"""PCA whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance V of the integer vectors is never built: every step needs products V Q with a
thin block Q only, and one is a pass over the table in which each task multiplies its centred
rows, ``X' (X Q)``, and the partial products are summed. An iteration filters the block by a
Chebyshev polynomial of V that stays within 1 on [0, cut], the unwanted part of the spectrum, and
grows fast above it (Zhou, Saad et al., 2006), then orthonormalises it (QR) and rotates it to
Ritz vectors (Rayleigh-Ritz).

Certified means: the wanted Ritz pairs' residuals have reached the rounding level of the
products, and a fresh random block, kept orthogonal to the wanted vectors and filtered in the same way, shows no
eigenvalue above the wanted ones. Without that the search raises.

The driver holds blocks of width x BLOCK_PER_WANTED * components doubles and the sums of at most
FAN tasks; rows never leave the executors.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import written

SCALE, SHIFT = 1024.0, 100_000
#: Columns of the block per wanted component: its lowest Ritz value is the cut of the filter.
BLOCK_PER_WANTED = 4
DEGREE = 12
MAX_ITERATIONS = 200
#: Partial sums that one task, or the driver, adds up.
FAN = 32
#: Cells that a task turns into doubles at a time.
CELLS = 4_000_000
#: Largest residual, as a share of the top eigenvalue, that can count as rounding.
ROUNDING = 1e-10


def integers(column: pa.Array) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Rows of a list column that are vectors of finite entries (their positions), and their
    values as integers, one block per width."""
    at = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    column = column.take(pa.array(at))
    width = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    bad = np.bincount(np.repeat(np.arange(len(at)), width)[~np.isfinite(values)], minlength=len(at)) > 0
    keep = ~bad & (width > 0)
    if not keep.all():
        values = values[np.repeat(keep, width)]
        at, width = at[keep], width[keep]
    scaled = np.floor(values * SCALE)
    if len(scaled) and np.abs(scaled).max() >= 2.0 ** 53:
        raise ValueError("an entry's magnitude is over 2**43: its integer is not exact in a double")
    return at, width, scaled.astype(np.int64) + SHIFT


def _pieces(batches, names: bool):
    """``(ids or None, matrix of integers)`` for the usable rows of the batches, CELLS at most at a time."""
    for batch in batches:
        column = batch.column(batch.num_columns - 1)
        lo, most = 0, max(1, CELLS // max(1, len(column.flatten()) // max(1, batch.num_rows)))
        while lo < batch.num_rows:
            part = column.slice(lo, most)
            at, width, x = integers(part)
            if len(at):
                d = int(width[0])
                if (width != d).any():
                    raise ValueError("vectors of unequal width")
                yield (batch.column(0).take(pa.array(at + lo)) if names else None), x.reshape(-1, d)
            lo += most


class Moments:
    """Rows and exact sums per dimension, and rows centred by them."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.base = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([(s % n) / n for s in sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n``: the whole part is taken off exactly, before anything is rounded."""
        return (x - self.base).astype(np.float64) - self.rest

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of ``(n * x - S) ** 2``, exact."""
        off = x - self.base
        rest = [s % self.n for s in self.sums]
        most = self.n * (int(np.abs(off).max()) + 1)
        if most * most * x.shape[1] < 2 ** 62:
            t = self.n * off - np.array(rest, np.int64)
            return (t * t).sum(axis=1).tolist()
        t = off.astype(object) * self.n - np.array(rest, object)
        return (t * t).sum(axis=1).tolist()


def moments(rows: DataFrame) -> Moments | None:
    """Exact count and sums of the usable rows of ``rows (embedding)``; None without any."""
    def run(batches):
        n, total = 0, None
        for _, x in _pieces(batches, False):
            wide = int(np.abs(x).max()) * len(x) >= 2 ** 62
            s = (x.astype(object) if wide else x).sum(axis=0)
            if total is not None and len(total) != len(s):
                raise ValueError("vectors of unequal width")
            total = [a + int(b) for a, b in zip(total or [0] * len(s), s)]
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([[str(t) for t in total]])], ["n", "sums"])

    parts = rows.mapInArrow(run, "n long, sums array<string>")
    cells = parts.select("n", F.size("sums").alias("width"), F.posexplode("sums").alias("dim", "s"))
    found = cells.groupBy("width", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    if len({r["width"] for r in found}) > 1:
        raise ValueError(f"vectors of unequal width: {sorted({r['width'] for r in found})}")
    found.sort(key=lambda r: r["dim"])
    return Moments(int(found[0]["n"]), [int(r["s"]) for r in found]) if found else None


def _added(parts: DataFrame, partitions: int) -> np.ndarray | None:
    """Sum of the tasks' ``part`` (doubles), FAN of them a task at a time until the driver adds up the last ones."""
    def run(batches):
        total = None
        for batch in batches:
            for part in batch.column(0):
                one = np.frombuffer(part.as_buffer())
                total = one.copy() if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    while partitions > FAN:
        partitions = -(-partitions // FAN)
        parts = parts.repartition(partitions).mapInArrow(run, "part binary")
    return sum(np.frombuffer(bytes(r["part"])) for r in parts.collect())


def product(rows: DataFrame, m: Moments, partitions: int) -> Callable[[np.ndarray], tuple[np.ndarray, float]]:
    """``Q -> (V Q, trace of V)``, one pass over ``rows`` each."""
    def apply(q: np.ndarray) -> tuple[np.ndarray, float]:
        def run(batches):
            total, trace = np.zeros(q.shape), 0.0
            for _, x in _pieces(batches, False):
                x = m.centred(x)
                total += x.T @ (x @ q)
                trace += float((x * x).sum())
            yield pa.RecordBatch.from_arrays([pa.array([np.append(total.ravel(), trace).tobytes()], pa.binary())], ["part"])

        flat = _added(rows.mapInArrow(run, "part binary"), partitions) / m.n
        return flat[:-1].reshape(q.shape), float(flat[-1])

    return apply


def filtered(apply, q: np.ndarray, vq: np.ndarray, cut: float, top: float) -> np.ndarray:
    """``T(V) q``: T is the Chebyshev polynomial of DEGREE over [0, cut], scaled to 1 at ``top``; ``vq`` is V q."""
    e = c = cut / 2
    first = e / (top - c)
    s, low, high = first, q, (vq - c * q) * (first / e)
    for _ in range(DEGREE - 1):
        t = 1 / (2 / first - s)
        low, high = high, (apply(high)[0] - c * high) * (2 * t / e) - (s * t) * low
        s = t
    return high


def _orthonormal(q: np.ndarray) -> np.ndarray:
    return np.linalg.qr(np.linalg.qr(q)[0])[0]


def top_eigenpairs(apply, width: int, wanted: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``wanted`` largest eigenvalues of V, falling, their unit vectors (columns) and V's trace.

    Eigenvalues that are zero to rounding are left out. The largest entry of each vector is positive.
    """
    rng = np.random.default_rng(seed)
    m = min(width, BLOCK_PER_WANTED * wanted)
    wanted = min(wanted, width)
    q, before = _orthonormal(rng.standard_normal((width, m))), np.inf
    for _ in range(MAX_ITERATIONS):
        y, trace = apply(q)
        if trace == 0:
            return np.empty(0), np.empty((width, 0)), 0.0
        h = q.T @ y
        ritz, u = np.linalg.eigh((h + h.T) / 2)
        ritz, u = ritz[::-1], u[:, ::-1]
        q, y = q @ u, y @ u
        worst = np.linalg.norm(y - q * ritz, axis=0)[:wanted].max() / ritz[0]
        # at rounding level a further iteration no longer halves the residual
        if worst <= ROUNDING and (worst > before / 2 or worst <= np.finfo(float).eps):
            break
        before = worst
        cut = max(float(ritz[-1]), ritz[0] * 1e-8)
        if m < width:
            q = _orthonormal(filtered(apply, q, y, cut, float(ritz[0])))
    else:
        raise RuntimeError(f"no certified eigenvectors in {MAX_ITERATIONS} iterations: residual {worst:.1e}")
    vectors, values = q[:, :wanted], ritz[:wanted]
    if m < width:
        rest = rng.standard_normal((width, m))
        for _ in range(2):
            rest = _orthonormal(rest - vectors @ (vectors.T @ rest))
            rest = filtered(apply, rest, apply(rest)[0], cut, float(ritz[0]))
        rest = _orthonormal(rest - vectors @ (vectors.T @ rest))
        rest = _orthonormal(rest - vectors @ (vectors.T @ rest))
        missed = np.linalg.eigvalsh(rest.T @ apply(rest)[0])[-1]
        if missed > values[-1] + 1e-9 * values[0]:
            raise RuntimeError(f"not certified: an eigenvalue {missed} was missed above {values[-1]}")
    keep = values > trace * width * np.finfo(float).eps
    vectors, values = vectors[:, keep], values[keep]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors * signs, trace


def whiten(embeddings: DataFrame, components: int = 8) -> DataFrame:
    """Query ``op11_chebyshev_whitening``: ``vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact``.

    One row per usable vector and component. Vectors that are null or empty or hold a null or
    non-finite entry are dropped; repeated rows and null ids stay as they are. Components whose variance
    is zero to rounding are left out, as nothing can be whitened along them: a single row, or rows
    all alike, give no rows, and vectors narrower than ``components`` give fewer. Vectors of unequal
    width and entries over 2**43 raise ValueError. ``deviation`` is null where it does not
    fit 64 bits; ``deviation_exact`` (decimal) always has it. Components of equal eigenvalues are any
    orthonormal vectors of their space. Further columns are not read.
    """
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"
    rows = embeddings.select("embedding").filter("embedding is not null")
    partitions = rows.rdd.getNumPartitions()
    m = moments(rows)
    none = embeddings.sparkSession.createDataFrame([], schema)
    if m is None:
        return none
    values, vectors, trace = top_eigenpairs(product(rows, m, partitions), len(m.sums), components)
    if not len(values):
        return none
    basis = vectors / np.sqrt(values)

    def run(batches):
        for ids, x in _pieces(batches, True):
            w = (m.centred(x) @ basis).ravel()
            offsets = np.arange(0, len(w) + 1, len(values), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([ids, pa.array([str(v) for v in m.deviations(x)]),
                                              pa.ListArray.from_arrays(offsets, pa.array(w))], ["vec_id", "deviation", "w"])

    whitened = written(embeddings.select("vec_id", "embedding").filter("embedding is not null").mapInArrow(
        run, f"vec_id {kind}, deviation string, w array<double>"), "whitened")
    k = len(values)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    cov = whitened.agg(*[F.avg(F.col("w")[i] * F.col("w")[j]) for i, j in pairs], *[F.avg(F.col("w")[i]) for i in range(k)]).first()
    error = max(abs(c - cov[len(pairs) + i] * cov[len(pairs) + j] - (i == j)) for (i, j), c in zip(pairs, cov))
    share = F.array(*[F.lit(float(v / trace)) for v in values])
    each = whitened.select("vec_id", F.col("deviation").cast("decimal(38,0)").alias("deviation_exact"), F.posexplode("w").alias("at", "whitened"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(m.n).cast("long").alias("n"), F.col("deviation_exact").try_cast("long").alias("deviation"),
                       "whitened", share[F.col("at")].alias("explained"), F.lit(float(error)).alias("identity_error"), "deviation_exact")
