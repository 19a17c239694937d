"""Whitening of embeddings by a matrix-free Jacobi-Davidson eigensolver.

The covariance is never formed. A product V B is one pass over the stored fit list: each partition
centres its vectors, multiplies them with B and back, and sends d x k numbers. Outer steps are
Rayleigh-Ritz on a search space that the driver holds (d x at most ``SPACE`` x components), inner ones
solve the projected correction equations (I - QQ')(V - theta)(I - QQ') t = -r for all open pairs at
once by MINRES, one pass for each inner step. A pair is locked when its residual has reached double
precision, and everything after is kept orthogonal to it.

Defined results. A vector counts if it is not null, has no null or non-finite entry, no entry beyond
2^40 in size, and the length that most such vectors have (of equally frequent lengths the longest, and
never 0). Ids may repeat and be null: each row gives its own rows. Repeated vectors count once in the
fit list. Components whose eigenvalue is zero to working precision have no whitened values and are
left out, so one vector alone, or an empty table, gives no rows. A deviation beyond a 64-bit integer
is null. Columns other than the id and the vector are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflux.llm.common import release, stage

COMPONENTS, SPACE, INNER, ROWS = 16, 5, 8, 4096
SCALE, SHIFT, LARGEST = 64, 1_000_000, 2.0**40
EPS = np.finfo(float).eps

Product = Callable[[np.ndarray], np.ndarray]


# ------------------------------------------------------------------ the eigensolver (driver, small matrices)


def minres(product: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Least-residual solutions of symmetric systems, one in each column, stepped together."""
    norm = lambda a: np.sqrt((a * a).sum(0))
    x, before, last = np.zeros_like(rhs), rhs.copy(), rhs.copy()
    w, w_before = np.zeros_like(rhs), np.zeros_like(rhs)
    beta = first = norm(rhs)
    beta_before = np.ones_like(beta)
    live = first > 0
    cs, sn, dbar, eps, phibar = -np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta), np.zeros_like(beta), beta.copy()
    for step in range(steps):
        if not live.any():
            break
        v = last / np.where(beta > 0, beta, 1)
        y = product(v)
        if step:
            y = y - beta / beta_before * before
        alpha = (v * y).sum(0)
        y = y - alpha / np.where(beta > 0, beta, 1) * last
        before, last = last, y
        beta_before, beta = np.where(beta > 0, beta, 1), norm(y)
        eps_before, delta, gbar = eps, cs * dbar + sn * alpha, sn * dbar - cs * alpha
        eps, dbar = sn * beta, -cs * beta
        gamma = np.maximum(np.hypot(gbar, beta), np.finfo(float).tiny)
        cs, sn = gbar / gamma, beta / gamma
        phi, phibar = cs * phibar, sn * phibar
        w_before, w = w, (v - eps_before * w_before - delta * w) / gamma
        x = x + np.where(live, phi * w, 0)
        live &= (phibar > tolerance * first) & (beta > EPS * first)
    return x


def orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Orthonormal columns for what ``block`` adds to the spaces ``against``; spent directions are left out."""
    kept: list[np.ndarray] = []
    for t in block.T:
        size = np.linalg.norm(t)
        if not size > 0:
            continue
        t = t / size
        for _ in range(3):
            for q in against:
                t = t - q @ (q.T @ t)
            for q in kept:
                t = t - q * (q @ t)
            size = np.linalg.norm(t)
            if size < 1e-8:
                break
            t = t / size
        else:
            kept.append(t)
    return np.stack(kept, 1) if kept else np.zeros((len(block), 0))


def jacobi_davidson(product: Product, d: int, want: int, steps: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """The ``want`` largest eigenvalues of a symmetric positive operator, falling, and their unit vectors.

    Residuals reach ``tolerance`` times the largest eigenvalue, or the floor that a product's own
    rounding sets: Rayleigh-Ritz on the whole space, or a residual that three steps haven't lowered.
    """
    want = min(want, d)
    tolerance, floor, most = 8 * EPS * np.sqrt(d), 1e-11, min(d, SPACE * want)
    locked, values = np.zeros((d, 0)), np.zeros(0)
    basis = orthonormal(np.random.default_rng(5).standard_normal((d, min(d, want + 4))))
    image = product(basis)
    best, since = np.inf, 0
    for _ in range(steps):
        small = basis.T @ image
        theta, s = np.linalg.eigh((small + small.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        x, ax = basis @ s, image @ s
        # deflation keeps the search space orthogonal to what is locked, residuals too
        residual = ax - x * theta
        residual -= locked @ (locked.T @ residual)
        top = max(values.max(initial=0), theta.max(initial=0))
        size = np.linalg.norm(residual, axis=0)
        open_pairs = min(want - len(values), len(theta))
        whole = len(theta) + len(values) >= d
        done = whole or top == 0
        worst = size[:open_pairs].max(initial=0)
        best, since = (worst, 0) if worst < best / 2 else (best, since + 1)
        good = (size <= tolerance * top) | done | ((since >= 3) & (size <= floor * top))
        n = int(np.argmin(good[:open_pairs])) if not good[:open_pairs].all() else open_pairs
        # a pair is locked only while all before it are: a later one may still be passed by
        if n:
            locked, values = np.concatenate([locked, x[:, :n]], 1), np.concatenate([values, theta[:n]])
            best, since = np.inf, 0
        if len(values) == want:
            order = np.argsort(-values, kind="stable")
            q, _ = np.linalg.qr(locked[:, order])
            return values[order], q
        basis, image, theta, residual = x[:, n:], ax[:, n:], theta[n:], residual[:, n:]
        k = min(want - len(values), len(theta))
        if basis.shape[1] + k > most:
            keep = min(basis.shape[1], k + 8)
            basis, image = basis[:, :keep], image[:, :keep]
        x, th = basis[:, :k], theta[:k]

        def project(t: np.ndarray) -> np.ndarray:
            t = t - locked @ (locked.T @ t)
            return t - x * (x * t).sum(0)

        def corrected(t: np.ndarray) -> np.ndarray:
            t = project(t)
            return project(product(t) - t * th)

        t = minres(corrected, project(-residual[:, :k]), INNER, 1e-3)
        new = orthonormal(t, locked, basis)
        if not new.shape[1]:
            new = orthonormal(np.random.default_rng(len(values) + 7).standard_normal((d, k)), locked, basis)
        basis, image = np.concatenate([basis, new], 1), np.concatenate([image, product(new)], 1)
    raise ArithmeticError("the eigenvectors have not converged")


# ------------------------------------------------------------------ passes over the data


def usable(embeddings: DataFrame, vector: str, vec_id: str = "vec_id") -> DataFrame:
    """vec_id, d and x of each vector that counts apart from its length: x is 64-bit integers, little-endian."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch["v"]
            present = rows.is_valid()
            kept = batch.filter(present)
            rows = kept["v"]
            sizes = np.asarray(rows.value_lengths()).astype(np.int64)
            flat = rows.flatten()
            c = np.asarray(flat.cast(pa.float64()).fill_null(float("nan")))
            bad = ~(np.abs(c) <= LARGEST)
            edge = np.concatenate([[0], np.cumsum(sizes)])
            wrong = np.concatenate([[0], np.cumsum(bad)])
            fine = wrong[edge[1:]] == wrong[edge[:-1]]
            x = np.floor(SCALE * np.where(bad, 0, c)).astype("<i8") + SHIFT
            data = x.tobytes()
            packed = [data[8 * a : 8 * b] for a, b, ok in zip(edge[:-1].tolist(), edge[1:].tolist(), fine.tolist()) if ok]
            yield pa.RecordBatch.from_arrays([kept["vec_id"].filter(pa.array(fine)), pa.array(sizes[fine].astype(np.int32)), pa.array(packed, pa.binary())], ["vec_id", "d", "x"])

    rows = embeddings.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(pack, f"vec_id {kind}, d int, x binary")


def packed(vectors: DataFrame) -> DataFrame:
    """rows, block: up to ``ROWS`` vectors' x one after another."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch["x"].slice(at, ROWS)
                yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int64()), pa.array([b"".join(part.to_pylist())], pa.binary())], ["rows", "block"])

    return vectors.select("x").mapInArrow(join, "rows long, block binary")


@dataclass
class FitList:
    """The distinct vectors as stored blocks; ``n`` of them, of ``d`` entries that sum to ``s``."""

    blocks: DataFrame
    d: int
    n: int
    s: np.ndarray

    def reduce(self, size: int, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum of ``work``, ``size`` numbers, over the centred vectors (x - S/n) of all blocks."""
        d, n, s = self.d, self.n, self.s

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                for block in batch["block"]:
                    total += work(centred(np.frombuffer(block.as_buffer(), "<i8").reshape(-1, d), n, s)).ravel()
            if total.any():
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["i", "v"])

        out = np.zeros(size)
        for r in self.blocks.select("block").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
            out[r["i"]] = r["v"]
        return out

    def product(self, b: np.ndarray) -> np.ndarray:
        """Covariance times ``b`` without the covariance."""
        d, k = b.shape
        return self.reduce(d * k, lambda z: z.T @ (z @ b)).reshape(d, k) / self.n

    def trace(self) -> float:
        return float(self.reduce(1, lambda z: np.array([np.einsum("ij,ij", z, z)]))[0]) / self.n


def centred(x: np.ndarray, n: int, s: np.ndarray) -> np.ndarray:
    """x - S/n, from the exact n*x - S where that fits 64 bits."""
    if n * (np.abs(x).max(initial=0) + 1) < 2**62:
        return (n * x - s) / n
    return (x - s // n) - (s % n) / n


def deviations(x: np.ndarray, n: int, s: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n*x - S)^2, exactly; None beyond 64 bits."""
    bound = (n * (np.abs(x).max(initial=0).item() + 1) + max(map(abs, s.tolist()), default=0)) if x.size else 0
    if bound < 2**62:
        y = n * x - s
        if int(np.abs(y).max(initial=0)) ** 2 * max(1, x.shape[1]) < 2**63:
            return (y * y).sum(1).tolist()
    y = n * x.astype(object) - s.astype(object)
    return [v if v < 2**63 else None for v in (y * y).sum(1).tolist()]


def fit_list(vectors: DataFrame, d: int) -> FitList:
    """The distinct vectors of length ``d``, stored, with their count and exact sums."""
    blocks = stage(packed(vectors.where(F.col("d") == d).select("x").distinct()), "fit")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, np.zeros(d, np.int64)
        for batch in batches:
            for block in batch["block"]:
                x = np.frombuffer(block.as_buffer(), "<i8").reshape(-1, d)
                n, s = n + len(x), s + x.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, d, dtype=np.int32)), pa.array(np.concatenate([[n], s]))], ["i", "v"])

    rows = {r["i"]: r["v"] for r in blocks.select("block").mapInArrow(sums, "i int, v long").groupBy("i").agg(F.sum("v").alias("v")).collect()}
    return FitList(blocks, d, rows.get(-1, 0), np.array([rows.get(i, 0) for i in range(d)], np.int64))


@dataclass
class Whitening:
    """Unit vectors in the columns of ``axes``, their eigenvalues, the trace and the measured error."""

    values: np.ndarray
    axes: np.ndarray
    trace: float
    error: float


def fit(data: FitList, components: int = COMPONENTS) -> Whitening:
    values, axes = jacobi_davidson(data.product, data.d, components)
    there = values > 8 * EPS * data.d * max(values.max(initial=0), np.finfo(float).tiny)
    values, axes = values[there], axes[:, there]
    k = len(values)
    to = axes / np.sqrt(values)
    second = data.reduce(k * (k + 1), lambda z: np.concatenate([(w := z @ to).T @ w, w.sum(0)[None]])).reshape(k + 1, k) / data.n
    error = np.abs(second[:k] - np.outer(second[k], second[k]) - np.eye(k)).max(initial=0)
    return Whitening(values, axes, data.trace(), float(error))


def whiten(vectors: DataFrame, data: FitList, model: Whitening) -> DataFrame:
    """A row for each vector and component, as the contract of ``whitened_components`` has them."""
    d, n, s = data.d, data.n, data.s
    k = len(model.values)
    to, share = model.axes / np.sqrt(model.values), model.values / model.trace
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                m = part.num_rows
                x = np.frombuffer(b"".join(part["x"].to_pylist()), "<i8").reshape(m, d)
                each = pa.array(np.repeat(np.arange(m), k))
                columns = [
                    part["vec_id"].take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, np.int64)),
                    pa.array(deviations(x, n, s), pa.int64()).take(each),
                    pa.array((centred(x, n, s) @ to).ravel()),
                    pa.array(np.tile(share, m)),
                    pa.array(np.full(m * k, model.error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)
        release()

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.where(F.col("d") == d).select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whitened_components(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of each usable row and component."""
    vectors = stage(usable(embeddings, vector), "vectors")
    lengths = vectors.where("d > 0").groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:  # none counts
        kind = vectors.schema["vec_id"].dataType.simpleString()
        return embeddings.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    data = fit_list(vectors, lengths["d"])
    return whiten(vectors, data, fit(data, components))
