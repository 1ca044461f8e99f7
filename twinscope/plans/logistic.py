"""Penalised logistic regressions of all folds and settings of a search, fitted side by side.

A pass over the table gives the loss, gradient and curvature of every model at once, as products
of blocks of rows; the driver gets these sums, one row per task, and takes a Newton step for each
model. The curvature takes penalties of both kinds, so a search needs some dozens of passes in all.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinscope.sources.scratch import written

#: Rows of a packed block, and of a task at most, on average.
BLOCK_ROWS, TASK_ROWS = 4096, 100_000
#: A step has to gain this share of what it promises, else it is halved.
GAIN = 1e-4


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            x = part.column("x").flatten().to_numpy().reshape(part.num_rows, -1)
            fold, label = (part.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("fold", "label"))
            block = np.column_stack([fold, label, np.ones(len(x)), x])
            yield pa.RecordBatch.from_arrays([pa.array([len(block)], pa.int32()), pa.array([block.tobytes()], pa.binary())], ["n", "block"])


def packed(data: DataFrame) -> DataFrame:
    """``(label, features, fold)`` written as blocks of numbers, in tasks of even size."""
    parts = max(data.sparkSession.sparkContext.defaultParallelism, -(-data.count() // TASK_ROWS))
    rows = data.select("fold", "label", vector_to_array("features").alias("x")).repartition(parts)
    return written(rows.mapInArrow(_pack, "n int, block binary"), "search")


def _pass(blocks: DataFrame, left_out: np.ndarray, weights: np.ndarray, curved: bool) -> np.ndarray:
    """Sums over all rows for each model: rows, loss, gradient and curvature over the rows it learns
    from; or, not ``curved``, rows and hits over the rows of the fold it leaves out."""
    shipped = blocks.sparkSession.sparkContext.broadcast((left_out, weights))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, beta = shipped.value
        upper = np.triu_indices(beta.shape[1])
        total = None
        for batch in batches:
            for n, block in zip(batch.column("n").to_pylist(), batch.column("block").to_pylist(), strict=True):
                rows = np.frombuffer(block).reshape(n, -1)
                fold, y, x = rows[:, 0], rows[:, 1:2], rows[:, 2:]
                z = x @ beta.T
                out = fold[:, None] == own
                if curved:
                    part = (~out).astype(float)
                    p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
                    found = [part.sum(axis=0)[:, None], ((np.logaddexp(0, z) - y * z) * part).sum(axis=0)[:, None]]
                    found += [((p - y) * part).T @ x, (p * (1 - p) * part).T @ (x[:, upper[0]] * x[:, upper[1]])]
                else:
                    found = [out.sum(axis=0)[:, None], (out & ((z > 0) == (y > 0.5))).sum(axis=0)[:, None]]
                sums = np.hstack(found).astype(float)
                total = sums if total is None else total + sums
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    parts = blocks.mapInArrow(add, "sums binary").collect()
    shipped.destroy()
    if not parts:
        raise ValueError("no rows to learn from")
    return sum(np.frombuffer(r.sums).reshape(len(weights), -1) for r in parts)


def _steps(beta: np.ndarray, slope: np.ndarray, curve: np.ndarray, l1: np.ndarray) -> np.ndarray:
    """The step of each model to the least value of its quadratic, penalty of absolute values included."""
    step = np.zeros_like(beta)
    width = beta.shape[1]
    curve = curve + np.eye(width) * (1e-12 * (1 + np.trace(curve, axis1=1, axis2=2)))[:, None, None]
    plain = l1 == 0
    if plain.any():
        step[plain] = np.linalg.solve(curve[plain], -slope[plain][:, :, None])[:, :, 0]
    if not plain.all():
        b, h, lim = beta[~plain], curve[~plain], l1[~plain]
        rest, new = slope[~plain].copy(), b.copy()  # slope of the quadratic at the new place
        for _ in range(1000):
            moved = 0.0
            for j in range(width):
                aim = new[:, j] - rest[:, j] / h[:, j, j]
                if j:
                    aim = np.sign(aim) * np.maximum(np.abs(aim) - lim / h[:, j, j], 0)
                by = aim - new[:, j]
                new[:, j] = aim
                rest += by[:, None] * h[:, :, j]
                moved = max(moved, float(np.abs(by).max()))
            if moved < 1e-9:
                break
        step[~plain] = new - b
    return step


def fit(blocks: DataFrame, left_out: np.ndarray, reg: np.ndarray, ratio: np.ndarray, max_iter: int, tol: float) -> np.ndarray:
    """Offset and coefficients of each model: the mean loss over the rows outside its fold, plus
    ``reg`` times (``ratio`` of the absolute values, the rest of half the squares); the offset is free.

    A model stands still when its next step promises less than ``tol`` squared of its loss.
    """
    l1, l2 = reg * ratio, reg * (1 - ratio)
    width = len(np.frombuffer(blocks.first().block)) // blocks.first().n - 2
    upper = np.triu_indices(width)
    beta = np.zeros((len(reg), width))
    slope, curve, step = np.zeros_like(beta), np.zeros((len(reg), width, width)), np.zeros_like(beta)
    best, promise, share = np.full(len(reg), np.inf), np.zeros(len(reg)), np.ones(len(reg))
    moving = np.ones(len(reg), bool)
    for _ in range(max_iter):
        trial = beta + share[:, None] * step
        seen = _pass(blocks, left_out[moving], trial[moving], True)
        n = np.maximum(seen[:, :1], 1)
        inner = trial[moving, 1:]
        loss = (seen[:, 1:2] / n)[:, 0] + l1[moving] * np.abs(inner).sum(axis=1) + l2[moving] / 2 * (inner**2).sum(axis=1)
        good = loss <= best[moving] + GAIN * share[moving] * promise[moving]
        at = np.flatnonzero(moving)
        share[at[~good]] /= 2
        moving[at[~good & (share[at] < 1e-8)]] = False
        at, seen, n = at[good], seen[good], n[good]
        if not len(at):
            if moving.any():
                continue
            break
        beta[at], best[at], share[at] = trial[at], loss[good], 1.0
        slope[at] = seen[:, 2 : 2 + width] / n
        full = np.zeros((len(at), width, width))
        full[:, upper[0], upper[1]] = full[:, upper[1], upper[0]] = seen[:, 2 + width :] / n
        slope[at, 1:] += l2[at, None] * beta[at, 1:]
        full[:, range(1, width), range(1, width)] += l2[at, None]
        curve[at] = full
        step[at] = _steps(beta[at], slope[at], curve[at], l1[at])
        moved = np.abs(beta[at, 1:] + step[at, 1:]).sum(axis=1) - np.abs(beta[at, 1:]).sum(axis=1)
        promise[at] = (slope[at] * step[at]).sum(axis=1) + l1[at] * moved
        moving[at[-promise[at] <= tol**2 * np.maximum(np.abs(best[at]), 1e-12)]] = False
        if not moving.any():
            break
    return beta


def fold_accuracies(data: DataFrame, settings: Sequence[tuple[float, float]], folds: int, max_iter: int, tol: float) -> np.ndarray:
    """(folds, settings): share of right predictions on each fold by the model of the other folds,
    for settings (penalty, share of absolute values)."""
    blocks = packed(data)
    left_out = np.repeat(np.arange(folds, dtype=float), len(settings))
    reg, ratio = (np.tile([s[k] for s in settings], folds).astype(float) for k in (0, 1))
    hits = _pass(blocks, left_out, fit(blocks, left_out, reg, ratio, max_iter, tol), False)
    if not hits[:, 0].all():
        raise ValueError(f"The validation data at fold {int(left_out[hits[:, 0] == 0][0])} is empty.")
    return (hits[:, 1] / hits[:, 0]).reshape(folds, len(settings))
