"""Feed-forward nets trained by mini-batches over a partitioned table.

Rows are dealt to workers by a digest of their id, once, and written as one row per worker. A
round sends the weights to every worker, which goes through its rows in mini-batches, and takes
the mean of the workers' weights, by rows. With one worker this is plain mini-batch training, so
small tables need one job for all epochs. The models of all folds are trained side by side.

A row's ``fold`` k >= 0 trains the models of all other folds and validates the k-th; fold -1 does
neither. The last model learns from all rows that aren't ``held`` out, and is validated by those.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinscope.operators.sampling import order_key
from twinscope.sources.scratch import scratch_path

#: Rows of a worker, on average; the number of workers follows the table.
WORKER_ROWS = 2000
#: Numbers that are added up at a time when workers' weights are averaged.
SLOT = 1 << 18
#: Numbers that an optimiser goes over at a time: all its arrays of them fit a core's cache.
CACHED = 1 << 15
#: Weights of all workers that a task trains side by side.
STACK = 1 << 16
#: Step sizes and decay rates of the optimisers, as usual for each.
STEPS = {"sgd": 0.01, "rmsprop": 0.001, "adam": 0.001}
RMS_DECAY, ADAM_FIRST, ADAM_SECOND, TINY = 0.9, 0.9, 0.999, 1e-7


@dataclass(frozen=True)
class Net:
    """A net with one output; penalties act on the layers' kernels, not on their offsets."""

    hidden: tuple[int, ...] = (18, 9)
    activation: str = "relu"
    optimiser: str = "adam"
    batch: int = 20
    step: float | None = None
    l1: float = 0.0
    l2: float = 0.0
    seed: int = 99

    def sizes(self, inputs: int) -> list[tuple[int, int]]:
        widths = [inputs, *self.hidden, 1]
        return list(zip(widths[:-1], widths[1:]))


# --- one worker ---------------------------------------------------------------------------------


def start_weights(net: Net, inputs: int, models: int, kind: type) -> np.ndarray:
    """Uniform kernels scaled by the layer's width, zero offsets; the same for every model."""
    rng = np.random.default_rng(net.seed)
    parts = []
    for a, b in net.sizes(inputs):
        limit = math.sqrt(6 / (a + b))
        parts += [rng.uniform(-limit, limit, a * b), np.zeros(b)]
    return np.tile(np.concatenate(parts).astype(kind), (models, 1))


def layers(net: Net, inputs: int, flat: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Views of kernels (models, in, out) and offsets (models, 1, out) in flat weights (models, all).

    Here and below, arrays may have one more dimension in front, for workers side by side."""
    out, at = [], 0
    for a, b in net.sizes(inputs):
        out.append((flat[..., at : at + a * b].reshape(*flat.shape[:-1], a, b), flat[..., None, at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def forward(net: Net, inputs: int, weights: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
    """Every layer's output for each model; the last is (models, rows, 1) before the sigmoid.

    ``x`` may be narrower than the first layer: what is missing at its end is zero.
    """
    values = [x[..., None, :, :]]
    parts = layers(net, inputs, weights)
    for k, (kernel, offset) in enumerate(parts):
        z = values[-1] @ kernel[..., : values[-1].shape[-1], :] + offset
        if k < len(parts) - 1:
            z = np.maximum(z, 0) if net.activation == "relu" else np.tanh(z)
        values.append(z)
    return values


def losses(logits: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cross-entropy of each row: log(1 + e^z) - y z."""
    return np.logaddexp(0, logits) - y * logits


def gradient(net: Net, inputs: int, weights: np.ndarray, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Gradient of each model's mean loss over the rows it may learn from (``mask``: models, rows)."""
    values = forward(net, inputs, weights, x)
    out = np.zeros_like(weights)
    parts, gradients = layers(net, inputs, weights), layers(net, inputs, out)
    share = (mask / np.maximum(mask.sum(axis=-1, keepdims=True), 1)).astype(weights.dtype)
    delta = ((1 / (1 + np.exp(-values[-1][..., 0])) - y[..., None, :]) * share)[..., None].astype(weights.dtype)
    for k in reversed(range(len(parts))):
        before = values[k]
        width = before.shape[-1]
        gradients[k][0][..., :width, :] = np.swapaxes(before, -1, -2) @ delta
        gradients[k][1][:] = delta.sum(axis=-2, keepdims=True)
        if k:
            delta = delta @ np.swapaxes(parts[k][0], -1, -2)
            delta *= (before > 0) if net.activation == "relu" else 1 - before * before
    return out


@dataclass
class State:
    """Weights of several models, the optimiser's moments, and steps taken.

    ``models`` names each model by the fold it doesn't learn from, the last one by -1.
    """

    models: tuple[int, ...]
    weights: np.ndarray
    first: np.ndarray
    second: np.ndarray
    steps: float = 0.0

    @classmethod
    def of(cls, net: Net, weights: np.ndarray, models: tuple[int, ...] | None = None) -> State:
        none = np.zeros((len(weights), 0), weights.dtype)
        return cls(
            models if models is not None else (*range(len(weights) - 1), -1),
            weights.copy(),
            np.zeros_like(weights) if net.optimiser == "adam" else none,
            np.zeros_like(weights) if net.optimiser != "sgd" else none,
        )

    def copy(self) -> State:
        return State(self.models, self.weights.copy(), self.first.copy(), self.second.copy(), self.steps)

    def flat(self) -> np.ndarray:
        return np.concatenate([np.array([self.steps], self.weights.dtype), *[a.ravel() for a in (self.weights, self.first, self.second)]])

    def with_flat(self, flat: np.ndarray) -> State:
        at, parts = 1, []
        for a in (self.weights, self.first, self.second):
            parts.append(flat[at : at + a.size].reshape(a.shape).astype(a.dtype))
            at += a.size
        return State(self.models, *parts, float(flat[0]))


def take_step(net: Net, inputs: int, state: State, slope: np.ndarray) -> None:
    """One step of the optimiser, then the penalties: kernels decay (L2) and are pulled to zero
    by a constant, stopping there (L1)."""
    step = net.step if net.step is not None else STEPS[net.optimiser]
    state.steps += 1
    arrays = [a.reshape(-1) for a in (state.weights, state.first, state.second, slope)]
    for at in range(0, slope.size, CACHED):
        weights, first, second, g = (a[at : at + CACHED] for a in arrays)
        if net.optimiser == "sgd":
            weights -= step * g
        elif net.optimiser == "rmsprop":
            second *= RMS_DECAY
            second += (1 - RMS_DECAY) * g * g
            weights -= step * g / (np.sqrt(second) + TINY)
        else:
            # Both moments are corrected for their start at zero; the small constant comes after that.
            start = math.sqrt(1 - ADAM_SECOND**state.steps)
            first *= ADAM_FIRST
            first += (1 - ADAM_FIRST) * g
            second *= ADAM_SECOND
            second += (1 - ADAM_SECOND) * g * g
            weights -= (step * start / (1 - ADAM_FIRST**state.steps)) * first / (np.sqrt(second) + TINY * start)
    if net.l1 or net.l2:
        for kernel, _ in layers(net, inputs, state.weights):
            kernel /= 1 + 2 * step * net.l2
            np.copyto(kernel, np.sign(kernel) * np.maximum(np.abs(kernel) - step * net.l1, 0))


class Rows:
    """A worker's rows: numbers as they are, or words looked up in the worker's own vectors."""

    def __init__(self, rows: pa.Array, words: pa.Array | None, dim: int):
        fields = {f: rows.field(f) for f in ("id", "label", "fold", "held")}
        self.ids = fields["id"]
        self.y = fields["label"].to_numpy(zero_copy_only=False).astype(float)
        self.fold = fields["fold"].to_numpy(zero_copy_only=False)
        self.held = fields["held"].to_numpy(zero_copy_only=False)
        x = rows.field("x")
        self.learning = np.flatnonzero((self.fold >= 0) | ~self.held)
        self.offsets = x.offsets.to_numpy()
        flat = x.values.to_numpy(zero_copy_only=False)
        if words is None:
            self.table, self.kind = None, np.float64
            self.x = flat[self.offsets[0] : self.offsets[-1]].reshape(len(self.y), -1)
            return
        self.kind, self.dim = np.float32, dim
        known = words.field("idx").to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(known)
        vectors = words.field("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(known), dim)
        # Row 0 stands for words without a vector and for places after the end.
        self.table = np.vstack([np.zeros((1, dim), np.float32), vectors[order]])
        place = np.searchsorted(known[order], flat)
        place[place == len(known)] = 0
        found = known[order][place] == flat if len(known) else np.zeros(len(flat), bool)
        self.x = np.where(found, place + 1, 0).astype(np.int32)

    @classmethod
    def unpacked(cls, columns: dict[str, pa.Scalar]) -> Rows:
        """From a row of ``_packed``; ``ids`` may be missing."""
        own = cls.__new__(cls)
        own.ids = columns["ids"].values if "ids" in columns else None
        own.y, own.fold, own.held, x = (np.frombuffer(columns[c].as_buffer(), kind) for c, kind in PACKED.items())
        own.learning = np.flatnonzero((own.fold >= 0) | ~own.held)
        own.table, own.kind, own.x = None, np.float64, x.reshape(len(own.y), -1)
        return own

    def learned_by(self, models: tuple[int, ...], rows: np.ndarray) -> np.ndarray:
        """(models, rows): which of the rows each model learns from."""
        fold, free = self.fold[rows], ~self.held[rows]
        return np.array([free if k < 0 else (fold >= 0) & (fold != k) for k in models])

    def held_from(self, models: tuple[int, ...], rows: np.ndarray) -> np.ndarray:
        return np.array([self.held[rows] if k < 0 else self.fold[rows] == k for k in models])

    def take(self, rows: np.ndarray) -> np.ndarray:
        if self.table is None:
            return self.x[rows]
        begins, n = self.offsets[rows], self.offsets[rows + 1] - self.offsets[rows]
        inside = np.arange(max(int(n.max(initial=0)), 1)) < n[:, None]
        words = np.zeros(inside.shape, np.int32)
        words[inside] = self.x[np.repeat(begins - np.cumsum(n) + n, n) + np.arange(n.sum())]
        return self.table[words].reshape(len(rows), -1)


def measure(net: Net, inputs: int, state: State, rows: Rows) -> np.ndarray:
    """(models, 6): loss, hits and rows of the training part, then of the validation part."""
    out = np.zeros((len(state.models), 6))
    for at in range(0, len(rows.y), 256):
        some = np.arange(at, min(at + 256, len(rows.y)))
        y = rows.y[some]
        logits = forward(net, inputs, state.weights, rows.take(some))[-1][:, :, 0].astype(float)
        loss, hit = losses(logits, y), (logits > 0) == (y > 0.5)
        for k, part in enumerate((rows.learned_by(state.models, some), rows.held_from(state.models, some))):
            out[:, 3 * k : 3 * k + 3] += np.stack([(loss * part).sum(axis=1), (hit & part).sum(axis=1), part.sum(axis=1)], axis=1)
    return out


def run_epochs(net: Net, inputs: int, state: State, rows: Rows, epochs: range, worker: int) -> np.ndarray:
    """Train in place; returns what ``measure`` gives before each epoch."""
    seen = []
    for epoch in epochs:
        seen.append(measure(net, inputs, state, rows))
        order = np.random.default_rng((net.seed, epoch, worker)).permutation(rows.learning)
        for at in range(0, len(order), net.batch):
            some = order[at : at + net.batch]
            slope = gradient(net, inputs, state.weights, rows.take(some), rows.y[some], rows.learned_by(state.models, some))
            take_step(net, inputs, state, slope)
    return np.array(seen).reshape(-1, len(state.models), 6)


def run_side_by_side(net: Net, inputs: int, state: State, group: list[tuple[int, Rows]], epoch: int) -> list[tuple[np.ndarray, State]]:
    """One epoch of several workers (number, rows that are numbers), each from ``state``: what ``run_epochs``
    does for each of them alone.

    Mini-batches of the same place in the workers' orders are one stack, as a step on one of them is
    too little work for its calls. Workers that have more rows come first, so those that go on
    are the first ones; a worker's last mini-batch that is not full is a step of its own.
    """
    seen = [measure(net, inputs, state, rows) for _, rows in group]
    orders = [np.random.default_rng((net.seed, epoch, worker)).permutation(rows.learning) for worker, rows in group]
    places = sorted(range(len(group)), key=lambda k: -len(orders[k]))
    sizes = np.array([len(orders[k]) for k in places])
    x, y = np.zeros((len(group), sizes[0], inputs)), np.zeros((len(group), sizes[0]))
    mask = np.zeros((len(group), len(state.models), sizes[0]), bool)
    for at, (k, n) in enumerate(zip(places, sizes)):
        rows = group[k][1]
        x[at, :n], y[at, :n], mask[at, :, :n] = rows.take(orders[k]), rows.y[orders[k]], rows.learned_by(state.models, orders[k])
    weights, first, second = (np.repeat(a[None], len(group), axis=0) for a in (state.weights, state.first, state.second))

    def step(number: int, workers: slice, rows: slice) -> None:
        some = State(state.models, weights[workers], first[workers], second[workers], state.steps + number)
        take_step(net, inputs, some, gradient(net, inputs, some.weights, x[workers, rows], y[workers, rows], mask[workers, :, rows]))

    for number, at in enumerate(range(0, sizes[0], net.batch)):
        full, begun = int((sizes >= at + net.batch).sum()), int((sizes > at).sum())
        if full:
            step(number, slice(0, full), slice(at, at + net.batch))
        for k in range(full, begun):
            step(number, slice(k, k + 1), slice(at, sizes[k]))
    out: list = [None] * len(group)
    for at, (k, n) in enumerate(zip(places, sizes)):
        out[k] = seen[k][None], State(state.models, weights[at], first[at], second[at], state.steps + -(-int(n) // net.batch))
    return out


# --- all workers --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Shards:
    """A written table with one row per worker."""

    frame: DataFrame
    inputs: int
    workers: int
    folds: int
    dim: int = 0

    @property
    def kind(self) -> type:
        return np.float32 if self.dim else np.float64


def _dealt(df: DataFrame, x: str, seed: int) -> tuple[DataFrame, int]:
    workers = max(1, -(-df.count() // WORKER_ROWS))
    row = F.struct(order_key("id", seed).alias("key"), "id", "label", F.col("fold").cast("int").alias("fold"), "held", F.col(x).alias("x"))
    worker = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(workers)).cast("int")
    return df.select(worker.alias("worker"), row.alias("row")).where("row.label is not null"), workers


def _written(spark: SparkSession, df: DataFrame, files: int) -> DataFrame:
    path = scratch_path(spark, "workers")
    df.repartition(files).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Columns of a worker's rows that are written as bytes, and the kind of their numbers.
PACKED = {"label": np.float64, "fold": np.int32, "held": np.bool_, "x": np.float64}


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each worker's rows column by column, as bytes: they are read again in every round."""
    for batch in batches:
        for k in range(batch.num_rows):
            structs = batch.column("rows").slice(k, 1).flatten()
            rows = Rows(structs, None, 0)
            ids = pa.ListArray.from_arrays(pa.array([0, len(structs)], pa.int32()), structs.field("id"))
            parts = [a.astype(kind).tobytes() for a, kind in zip((rows.y, rows.fold, rows.held, rows.x), PACKED.values())]
            columns = [batch.column("worker").slice(k, 1), ids, *[pa.array([p], pa.binary()) for p in parts]]
            yield pa.RecordBatch.from_arrays(columns, ["worker", "ids", *PACKED])


def feature_shards(df: DataFrame, folds: int, seed: int = 99) -> Shards:
    """Deal ``(id, label, features, fold, held)`` with an ML vector to workers."""
    dealt, workers = _dealt(df.withColumn("_x", vector_to_array("features")), "_x", seed)
    rows = dealt.groupBy("worker").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    packed = rows.mapInArrow(_packed, f"worker int, ids array<bigint>, {', '.join(f'{c} binary' for c in PACKED)}")
    # Two files a core: to open one takes as long as the epoch of a few workers.
    frame = _written(df.sparkSession, packed, min(workers, 2 * int(df.sparkSession.sparkContext.defaultParallelism)))
    first = df.select(F.size(vector_to_array("features")).alias("n")).first()
    return Shards(frame, first.n if first else 0, workers, folds)


def word_shards(df: DataFrame, matrix: DataFrame, dim: int, folds: int, seed: int = 99) -> Shards:
    """Deal ``(id, label, seq, fold, held)`` with word numbers to workers, each with the vectors of its
    own words from ``matrix`` ``(idx, vector)``; neither texts nor matrix are made dense."""
    dealt, workers = _dealt(df, "seq", seed)
    rows = dealt.groupBy("worker").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    used = dealt.select("worker", F.explode(F.array_distinct("row.x")).alias("idx")).distinct()
    found = used.join(matrix.select(F.col("idx").cast("long"), F.col("vector").cast("array<float>").alias("vector")), "idx")
    words = found.groupBy("worker").agg(F.collect_list(F.struct("idx", "vector")).alias("words"))
    none = F.array().cast("array<struct<idx:bigint,vector:array<float>>>")
    joined = rows.join(words, "worker", "left").withColumn("words", F.coalesce("words", none))
    longest = df.agg(F.max(F.size("seq"))).first()[0] or 0
    # One worker a file, so that each can be a task of its own.
    return Shards(_written(df.sparkSession, joined, workers), max(longest, 1) * dim, workers, folds, dim)


def _shard_rows(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[int, Rows]]:
    for batch in batches:
        for k in range(batch.num_rows):
            one = batch.slice(k, 1)
            rows = Rows(one.column("rows").flatten(), one.column("words").flatten(), dim) if dim else Rows.unpacked({c: one.column(c)[0] for c in one.schema.names})
            yield one.column("worker")[0].as_py(), rows


def _trained(net: Net, inputs: int, dim: int, state: State, workers: Iterator[tuple[int, Rows]], epochs: range) -> Iterator[tuple[Rows, np.ndarray, State]]:
    """Each worker's rows, what it measured and its state after the epochs. Of one epoch, workers with rows of
    numbers are trained so many at a time that their weights fit a core's cache."""
    if dim or len(epochs) != 1:
        for worker, rows in workers:
            own = state.copy()
            yield rows, run_epochs(net, inputs, own, rows, epochs, worker), own
        return
    while group := list(islice(workers, max(1, STACK // max(state.weights.size, 1)))):
        for (_, rows), (seen, own) in zip(group, run_side_by_side(net, inputs, state, group, epochs[0])):
            yield rows, seen, own


def _round(shipped, inputs: int, dim: int, epochs: range):
    """A task's workers: the sum of their states by rows, of their rows, and of what they measured."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, state = shipped.value
        total, size, seen = 0.0, 0, 0.0
        workers = _shard_rows(batches, dim)
        if epochs:
            for rows, measured, own in _trained(net, inputs, dim, state, workers, epochs):
                seen, n = seen + measured, len(rows.learning)
                # The whole sum stays in the kind of the weights.
                size, total = size + n, total + own.flat() * state.weights.dtype.type(n)
        else:
            for _, rows in workers:
                seen = seen + measure(net, inputs, state, rows)[None]
        if isinstance(seen, float):
            return
        whole = [np.append(seen.ravel(), float(size))]
        if epochs:
            whole += np.split(total, range(SLOT, len(total), SLOT))
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(whole) - 1), pa.int32()), pa.array([w.tobytes() for w in whole], pa.binary())], ["slot", "data"])

    return train


def _numbers(slot: int, data: bytes, kind: type) -> np.ndarray:
    """Slot -1 holds what was measured, in doubles."""
    return np.frombuffer(data, float if slot < 0 else kind)


def _add(kind: type):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, data in zip(batch.column("slot").to_pylist(), batch.column("data").to_pylist(), strict=True):
                part = _numbers(slot, data, kind)
                sums[slot] = sums[slot] + part if slot in sums else part
        for slot, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["slot", "data"])

    return add


@dataclass
class Fit:
    """A trained net and what was measured after 0, 1, ... epochs: (epochs + 1, models, 6)."""

    net: Net
    state: State
    history: np.ndarray = field(repr=False)

    def accuracies(self, epochs: int) -> np.ndarray:
        """Validation accuracy of each fold's model after so many epochs."""
        held = self.history[epochs, :-1]
        return held[:, 4] / np.maximum(held[:, 5], 1)


def _one_round(shards: Shards, net: Net, state: State, epochs: range) -> tuple[State, np.ndarray]:
    context = shards.frame.sparkSession.sparkContext
    shipped = context.broadcast((net, state))
    schema = "slot int, data binary"
    frame = shards.frame.drop("ids")
    if not shards.dim:
        # A task's workers are trained side by side, so there are as many tasks as cores at most.
        frame = frame.coalesce(int(context.defaultParallelism))
    out = frame.mapInArrow(_round(shipped, shards.inputs, shards.dim, epochs), schema)
    if shards.workers > 1:
        slots = 1 + -(-state.flat().size // SLOT)
        out = out.repartition(min(slots, int(context.defaultParallelism)), "slot").mapInArrow(_add(shards.kind), schema)
    sums = {r.slot: _numbers(r.slot, r.data, shards.kind) for r in out.collect()}
    shipped.destroy()
    seen = sums.pop(-1, np.zeros(1 + max(len(epochs), 1) * len(state.weights) * 6))
    if epochs and seen[-1]:
        state = state.with_flat(np.concatenate([sums[k] for k in sorted(sums)]) / shards.kind(seen[-1]))
    return state, seen[:-1].reshape(-1, len(state.weights), 6)


def fit(shards: Shards, net: Net, epochs: int, start: State | None = None, meet: int = 1, split: int = 1, together: int | None = None) -> Fit:
    """Train for ``epochs`` epochs, from ``start`` on if given; the workers meet after every ``meet``.

    Only the weights' sums travel: each task adds up its workers, slots of the sum are added up
    by other tasks, and the driver gets one vector of the size of the models. With few workers
    the models can be ``split`` in parts that are trained side by side, or only so many parts
    ``together`` (the driver then holds no more at a time), with the same results.
    Rows without a label are left out; a table without rows leaves the weights as they were.
    Between meetings the history is that of the workers' own weights.
    """
    state = start or State.of(net, start_weights(net, shards.inputs, shards.folds + 1, shards.kind))
    at_once = epochs if shards.workers == 1 else meet

    def train(rows: np.ndarray) -> tuple[State, np.ndarray]:
        names, history = tuple(state.models[k] for k in rows), []
        part = State(names, state.weights[rows], state.first[rows], state.second[rows], state.steps)
        for at in range(0, epochs, max(at_once, 1)):
            part, seen = _one_round(shards, net, part, range(at, min(at + at_once, epochs)))
            history.append(seen)
        return part, np.concatenate([*history, _one_round(shards, net, part, range(0))[1]])

    parts = np.array_split(np.arange(len(state.models)), min(split, len(state.models)))
    with ThreadPoolExecutor(min(together or len(parts), len(parts))) as pool:
        done = list(pool.map(train, parts))
    whole = [np.concatenate([getattr(s, a) for s, _ in done]) for a in ("weights", "first", "second")]
    return Fit(net, State(state.models, *whole, done[0][0].steps), np.concatenate([h for _, h in done], axis=1))


def fit_all(shards: Shards, nets: Sequence[Net], epochs: int, parallelism: int = 8, meet: int = 1, split: int = 1) -> list[Fit]:
    """Train several nets on the same rows, their jobs side by side."""
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(lambda net: fit(shards, net, epochs, meet=meet, split=split), nets))


def fit_path(shards: Shards, nets: Sequence[Net], epochs: int) -> list[Fit]:
    """Train nets that differ in their penalties, each from the weights of the one before."""
    fits: list[Fit] = []
    for net in nets:
        start = State.of(net, fits[-1].state.weights) if fits else None
        fits.append(fit(shards, net, epochs, start))
    return fits


def predictions(shards: Shards, fitted: Fit, held_out: bool = True) -> DataFrame:
    """``(id, label, prediction, probability)`` of the last model, for the rows held out of it or for all."""
    inputs, dim = shards.inputs, shards.dim
    shipped = shards.frame.sparkSession.sparkContext.broadcast((fitted.net, fitted.state.weights[-1:]))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, weights = shipped.value
        for _, rows in _shard_rows(batches, dim):
            wanted = np.flatnonzero(rows.held) if held_out else np.arange(len(rows.y))
            for at in range(0, len(wanted), 256):
                some = wanted[at : at + 256]
                logits = forward(net, inputs, weights, rows.take(some))[-1][0, :, 0].astype(float)
                yield pa.RecordBatch.from_arrays(
                    [rows.ids.take(pa.array(some)), pa.array(rows.y[some].astype(np.int32)), pa.array((logits > 0).astype(np.int32)), pa.array(1 / (1 + np.exp(-logits)))],
                    ["id", "label", "prediction", "probability"],
                )

    return shards.frame.mapInArrow(predict, "id long, label int, prediction int, probability double")


# --- reports ------------------------------------------------------------------------------------


def describe(net: Net, *names: str) -> str:
    return ", ".join(f"{n}={getattr(net, n)}" for n in names)


def cv_table(spark: SparkSession, fits: Sequence[Fit], stages: Sequence[int], names: Sequence[str]) -> DataFrame:
    """One row per net and stage: mean and deviation of the folds' validation accuracies."""
    rows = []
    for f in fits:
        for epochs in stages:
            found = f.accuracies(epochs)
            rows.append((f"epochs={epochs}, {describe(f.net, *names)}", float(found.mean()), float(found.std())))
    return spark.createDataFrame(rows, "setting string, mean_accuracy double, std_accuracy double")


def history_rows(fitted: Fit) -> list[tuple[int, str, float, float]]:
    """(epochs done, part, loss, accuracy) of the last model."""
    rows = []
    for epoch, seen in enumerate(fitted.history[:, -1]):
        for part, (loss, hits, n) in (("train", seen[:3]), ("validation", seen[3:])):
            if n:
                rows.append((epoch, part, float(loss / n), float(hits / n)))
    return rows


def best_of_history(spark: SparkSession, fitted: Fit) -> DataFrame:
    """For each part the best accuracy and the lowest loss after any epoch, and when they were reached first."""
    history = spark.createDataFrame(history_rows(fitted), "epoch int, part string, loss double, accuracy double")
    best = history.where("epoch > 0").groupBy("part").agg(
        F.max(F.struct("accuracy", (-F.col("epoch")).alias("e"))).alias("a"), F.min(F.struct("loss", "epoch")).alias("l"), F.max("epoch").alias("epochs")
    )
    return best.select(
        "part", "epochs", F.col("a.accuracy").alias("best_accuracy"), (-F.col("a.e")).alias("best_accuracy_epoch"),
        F.col("l.loss").alias("lowest_loss"), F.col("l.epoch").alias("lowest_loss_epoch"),
    )


def penalty_path(net: Net, l2: Sequence[float] = (), l1: Sequence[float] = ()) -> list[Net]:
    """The net with each penalty, from the weakest to the strongest, so that fits can go on from
    the one before. (A strong penalty leaves a net of zeros, from which no fit gets away.)"""
    return [replace(net, l2=x) for x in sorted(l2)] + [replace(net, l1=x) for x in sorted(l1)]
