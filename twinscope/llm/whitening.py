"""Embedding whitening: leading eigenvectors of a covariance that is never formed, by Jacobi-Davidson."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinscope.llm.components import written

#: Embedding entries are taken in steps of 1 / SCALE; larger ones than LARGEST stop the fit.
SCALE, LARGEST = 256.0, float(1 << 45)
#: Bytes of a block of packed vectors.
BLOCK_BYTES = 1 << 20
#: Bytes of blocks behind a task, at least: a task adds one row for each number of a product.
TASK_BYTES = 4 << 20
#: Steps of the inner solver in one round, and where it stops earlier (share of the residual left).
INNER_STEPS, INNER_LEFT = 12, 0.02
#: Columns of the search space before it is restarted, for each wanted eigenvector.
SPACE = 12
#: A residual is at double precision below this share of the largest eigenvalue.
PRECISION = 64 * np.finfo(float).eps
#: Components with a smaller share of the variance have none.
NO_VARIANCE = 1e-12


# --- vectors ------------------------------------------------------------------------------------


def whole_vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a vector of finite numbers, and these vectors as longs: floor(256 c)."""
    column = column.cast(pa.large_list(pa.float64()))
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    bad = np.append(0, np.cumsum(~np.isfinite(values)))
    ends = np.cumsum(lengths)
    keep = (lengths > 0) & (bad[ends] == bad[ends - lengths])
    kinds = np.unique(lengths[keep])
    if len(kinds) > 1:
        raise ValueError(f"vectors have lengths {kinds.tolist()}")
    values = values[np.repeat(keep, lengths)]
    if len(values) and np.abs(values).max() >= LARGEST:
        raise ValueError(f"an entry is not below {LARGEST}")
    return keep, np.floor(SCALE * values).astype(np.int64).reshape(int(keep.sum()), int(kinds[0]) if len(kinds) else 0)


def pack(x: np.ndarray) -> list[bytes]:
    """Each row in the smallest integers that hold it, after a byte that names their size."""
    most = np.abs(x).max(axis=1, initial=0)
    size = np.where(most < 1 << 15, 2, np.where(most < 1 << 31, 4, 8))
    out = [b""] * len(x)
    for s in np.unique(size):
        rows = np.flatnonzero(size == s)
        body = x[rows].astype(f"<i{s}").tobytes()
        width = s * x.shape[1]
        for k, row in enumerate(rows.tolist()):
            out[row] = bytes([s]) + body[k * width : (k + 1) * width]
    return out


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(pack(whole_vectors(batch.column(0))[1]), pa.binary())], ["x"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of one integer size side by side, about ``BLOCK_BYTES`` in a row."""
    held: dict[tuple[int, int], list[bytes]] = {}

    def block(kind: tuple[int, int]) -> pa.RecordBatch:
        rows = held.pop(kind)
        size, width = kind
        return pa.RecordBatch.from_arrays(
            [pa.array([size], pa.int32()), pa.array([(width - 1) // size], pa.int32()), pa.array([len(rows)], pa.int64()), pa.array([b"".join(r[1:] for r in rows)], pa.binary())],
            ["size", "dim", "rows", "data"],
        )

    for batch in batches:
        for key in batch.column("x").to_pylist():
            kind = (key[0], len(key))
            held.setdefault(kind, []).append(key)
            if len(held[kind]) * len(key) >= BLOCK_BYTES:
                yield block(kind)
    for kind in list(held):
        yield block(kind)


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for size, dim, data in zip(*(batch.column(c).to_pylist() for c in ("size", "dim", "data")), strict=True):
            yield np.frombuffer(data, f"<i{size}").reshape(-1, dim)


def _sums(dim: int):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dim
        for x in _matrices(batches):
            # A block's sum fits: fewer than 2**19 entries, each below 2**53.
            wide = x.astype(object).sum(axis=0) if x.dtype.itemsize == 8 else x.sum(axis=0, dtype=np.int64)
            total = [t + int(v) for t, v in zip(total, wide, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([str(t) for t in total])], ["at", "total"])

    return sums


def _added(blocks: DataFrame, part: Callable[[np.ndarray], np.ndarray], length: int) -> np.ndarray:
    """Sum over all blocks of a function that gives ``length`` numbers for each matrix of vectors."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for x in _matrices(batches):
            total += part(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(length, dtype=np.int32)), pa.array(total)], ["at", "value"])

    out = np.zeros(length)
    for row in blocks.mapInArrow(parts, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect():
        out[row.at] = row.value
    return out


# --- Jacobi-Davidson ----------------------------------------------------------------------------


def _outside(t: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The part of ``t`` at right angles to the columns of ``basis``, cleaned twice."""
    for _ in range(2):
        t = t - basis @ (basis.T @ t)
    return t


def _orthonormal(t: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """Unit vectors that add the directions of ``t`` to ``bases``; those that add none are left out."""
    done = np.hstack(bases) if bases else np.zeros((len(t), 0))
    new = []
    for c in range(t.shape[1]):
        v, size = t[:, c : c + 1], np.linalg.norm(t[:, c])
        if size > 0 and done.shape[1] < len(t):
            v = _outside(v / size, done)
            left = np.linalg.norm(v)
            if left > 1e-10:
                v = _outside(v / left, done)
                done = np.hstack([done, v / np.linalg.norm(v)])
                new.append(done[:, -1:])
    return np.hstack(new) if new else np.zeros((len(t), 0))


def corrections(product: Callable[[np.ndarray], np.ndarray], theta: np.ndarray, vectors: np.ndarray, residuals: np.ndarray, locked: np.ndarray) -> np.ndarray:
    """Approximate solutions t of (I - P)(A - theta I)(I - P) t = -r for each Ritz pair by MINRES.

    P projects on the locked vectors and the pair's own. The recurrences of all pairs run side
    by side, so a step costs one product with a block.
    """
    m = vectors.shape[1]
    bases = [np.hstack([locked, vectors[:, c : c + 1]]) for c in range(m)]

    def project(t: np.ndarray) -> np.ndarray:
        return np.hstack([_outside(t[:, c : c + 1], bases[c]) for c in range(m)])

    v = project(-residuals)
    beta = np.linalg.norm(v, axis=0)
    start, eta = beta.copy(), beta.copy()
    safe = lambda x: np.where(x > 0, x, 1.0)
    v, before = v / safe(beta), np.zeros_like(v)
    w, w_before, t = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    c, c_before, s, s_before = (np.full(m, x) for x in (1.0, 1.0, 0.0, 0.0))
    running = beta > 0
    beta = np.zeros(m)
    for _ in range(INNER_STEPS):
        if not running.any():
            break
        step = project(product(v) - v * theta)
        alpha = np.einsum("ij,ij->j", v, step)
        step = step - v * alpha - before * beta
        following = np.linalg.norm(step, axis=0)
        # Rotations that keep the small least-squares problem triangular.
        delta = c * alpha - c_before * s * beta
        rho = np.hypot(delta, following)
        upper, far = s * alpha + c_before * c * beta, s_before * beta
        running &= rho > 0
        fresh = (v - w * upper - w_before * far) / safe(rho)
        c_before, s_before, c, s = c, s, np.where(rho > 0, delta / safe(rho), 1.0), np.where(rho > 0, following / safe(rho), 0.0)
        t = t + np.where(running, c * eta, 0.0) * fresh
        w_before, w = w, fresh
        eta = -s * eta
        running &= (np.abs(eta) > INNER_LEFT * start) & (following > 0)
        before, v, beta = v, step / safe(following), following
    return t


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, seed: int = 7, most_rounds: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues and unit eigenvectors of a symmetric matrix of which only
    products with blocks are known.

    Each round takes the Ritz pairs of the search space, locks the leading ones whose residual
    is at double precision, and widens the space by the others' corrections. A full space is
    restarted with its best half. A residual that has stopped falling near that precision is as
    good as the products' rounding allows, and is locked too.
    """
    wanted = min(wanted, dim)
    space = _orthonormal(np.random.default_rng(seed).standard_normal((dim, min(dim, 2 * wanted))))
    images = product(space)
    locked, values = np.zeros((dim, 0)), []
    largest, best, stuck = 0.0, np.inf, 0
    for _ in range(most_rounds):
        small = space.T @ images
        theta, inside = np.linalg.eigh((small + small.T) / 2)
        theta, inside = theta[::-1], inside[:, ::-1]
        space, images = space @ inside, images @ inside
        need = wanted - locked.shape[1]
        largest = max([largest, *np.abs(theta[:1])])
        residuals = _outside(images[:, :need] - space[:, :need] * theta[:need], locked)
        sizes = np.linalg.norm(residuals, axis=0)
        stuck = stuck + 1 if sizes[0] > best / 2 else 0
        best = min(best, sizes[0])
        done = 0
        while done < need and (sizes[done] <= PRECISION * largest or (done == 0 and stuck >= 3 and sizes[0] <= 1e-11 * largest)):
            done += 1
        if done:
            locked, values = np.hstack([locked, space[:, :done]]), [*values, *theta[:done]]
            space, images, theta = space[:, done:], images[:, done:], theta[done:]
            best, stuck, need = np.inf, 0, need - done
            if not need:
                return np.array(values), locked
            residuals = residuals[:, done:]
            if not space.shape[1]:
                space = _orthonormal(np.random.default_rng(seed).standard_normal((dim, need)), locked)
                images = _outside(product(space), locked)
                continue
        if space.shape[1] > SPACE * wanted:
            space, images = space[:, : SPACE * wanted // 2], images[:, : SPACE * wanted // 2]
        active = min(need, space.shape[1])
        new = _orthonormal(corrections(product, theta[:active], space[:, :active], residuals[:, :active], locked), locked, space)
        if not new.shape[1]:
            # The corrections lie in the space already: other directions, if there are any.
            new = _orthonormal(np.random.default_rng(seed + space.shape[1]).standard_normal((dim, need)), locked, space)
        if new.shape[1]:
            space, images = np.hstack([space, new]), np.hstack([images, _outside(product(new), locked)])
    raise RuntimeError(f"residual {best} after {most_rounds} rounds")


# --- fit and use --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """A fit: distinct vectors, their sums, and the components by falling variance."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float


def fit(rows: DataFrame, vector: str = "embedding", k: int = 4) -> Whitening:
    """Learn the first ``k`` components from each distinct vector of ``rows``, once each.

    Vectors become whole numbers, are packed, told apart by a shuffle on the packed bytes
    (copies are dropped before it, too) and written in blocks. Each product with the covariance
    is one pass over the blocks: centred vectors times a few columns, summed by entry, so the
    driver gets one number for each entry of the columns. The covariance is never formed.

    Rows whose vector is null, empty, or holds an entry that is null or not finite are left out.
    Components without variance (fewer distinct vectors than ``k``, or equal entries) are not
    there; an empty table has none. Vectors of different lengths, and entries of 2**45 or more,
    stop the fit with an error. Other columns are not looked at.
    """
    blocks = written(rows.select(vector).mapInArrow(_keys, "x binary").distinct().mapInArrow(_blocks, "size int, dim int, rows long, data binary"), "vectors")
    n, dim, other, size = blocks.agg(F.sum("rows"), F.max("dim"), F.min("dim"), F.sum(F.octet_length("data").cast("long"))).first()
    if not n:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    # However many files the shuffle left, tasks follow the bytes.
    blocks = blocks.coalesce(-(-size // TASK_BYTES))
    if dim != other:
        raise ValueError(f"vectors have lengths {other} to {dim}")
    totals = blocks.mapInArrow(_sums(dim), "at int, total string").groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    sums = [int(r.total) for r in sorted(totals.collect(), key=lambda r: r.at)]
    mean = np.array([s / n for s in sums])
    trace = _added(blocks, lambda x: np.array([((x - mean) ** 2).sum()]), 1)[0] / n

    def product(columns: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            y = x - mean
            return (y.T @ (y @ columns)).reshape(-1)

        return _added(blocks, part, columns.size).reshape(columns.shape) / n

    if trace <= 0:
        return Whitening(n, sums, np.zeros((dim, 0)), np.zeros(0), 0.0, 0.0)
    values, vectors = jacobi_davidson(product, dim, k)
    # Components of nearly equal variance may have been locked out of order.
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > NO_VARIANCE * trace]
    values, vectors = values[order], vectors[:, order]
    m = len(values)

    def moments(x: np.ndarray) -> np.ndarray:
        y = (x - mean) @ vectors / np.sqrt(values)
        return np.concatenate([(y.T @ y).reshape(-1), y.sum(axis=0)])

    found = _added(blocks, moments, m * m + m) / n
    covariance = found[: m * m].reshape(m, m) - np.outer(found[m * m :], found[m * m :])
    return Whitening(n, sums, vectors, values, float(trace), float(np.abs(covariance - np.eye(m)).max(initial=0)))


def _whitened(model: Whitening, vector: str, columns: list[str]):
    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean = np.array([s / model.n for s in model.sums]) if model.n else np.zeros(0)
        scaled = model.vectors / np.sqrt(model.values)
        for batch in batches:
            keep, x = whole_vectors(batch.column(vector))
            if len(x) and x.shape[1] != len(mean):
                raise ValueError(f"a vector has length {x.shape[1]}, the fit {len(mean)}")
            if not len(x):
                deviation, out = np.zeros(0, np.int64), np.zeros((0, len(model.values)))
            else:
                if float(np.abs(x.astype(float) * model.n - [float(s) for s in model.sums]).max()) ** 2 * len(mean) >= 2.0**62:
                    raise OverflowError("a deviation doesn't fit 64 bits")
                gap = x * np.int64(model.n) - np.array(model.sums, np.int64)
                deviation, out = (gap * gap).sum(axis=1), (x - mean) @ scaled
            m = out.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * m), pa.array(out.reshape(-1)))
            kept = batch.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([*[kept.column(c) for c in columns], pa.array(deviation, pa.int64()), lists], [*columns, "deviation", "whitened"])

    return whitened


def transform(rows: DataFrame, model: Whitening, vector: str = "embedding") -> DataFrame:
    """Rows with a whole vector, without it, and with ``deviation`` (the sum over dimensions of
    (n x - S) squared, exact) and ``whitened`` (one number for each component of the fit).

    Null ids, ties and repeated rows are kept; rows the fit leaves out are left out. A deviation
    beyond 64 bits is an error. Columns of ``rows`` named like the added ones are replaced.
    """
    rows = rows.drop("deviation", "whitened")
    columns = [c for c in rows.columns if c != vector]
    schema = rows.select(*columns, F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened")).schema
    return rows.mapInArrow(_whitened(model, vector, columns), schema)
