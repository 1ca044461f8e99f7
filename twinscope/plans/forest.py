"""Random forests whose trees are grown by tasks and kept as a table; no tree comes to the driver.

Features become numbers of bins (``BINS`` at most) and rows are written once, packed by ``shards``. Every
tree draws how often it takes a row (Poisson, mean 1) from the seed, the tree and the shard, so any
task can draw it again. A table of ``UNIT_ROWS`` rows at most is one unit: its trees are dealt to tasks, which
grow them whole. Of a larger one, the nodes that have more rows are split first, level by level, by histograms that
tasks add up; then each node below is a unit, whose rows go to the task that grows the rest from there.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinscope.sources.scratch import scratch_path, written

#: Bins of a feature, and values of its sorted column that their limits are chosen from.
BINS, POINTS = 32, 10_000
#: Rows of a packed shard, on average.
SHARD_ROWS = 8000
#: Rows that a task grows trees from at a time.
UNIT_ROWS = 1 << 21
#: A node's histogram is dense if it has so many rows on average for each bin.
DENSE = 1
#: A tree's nodes: what is compared, the last bin that goes left, the left child (the right one comes next),
#: or minus one and the number of a leaf; and shares of the classes by leaf.
NODES = {"feature": np.int16, "bin": np.uint8, "left": np.int32, "share": np.float64}
_TREE = f"tree int, node int, {', '.join(f'{c} binary' for c in NODES)}"


# --- bins -----------------------------------------------------------------------------------------


def limits(points: Sequence[float], most: int) -> np.ndarray:
    """Limits between bins, ``most`` at most: midpoints of neighbours, as even in rows as values allow."""
    values, counts = np.unique(np.asarray(points, float), return_counts=True)
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) <= most:
        return middle
    found, stride = [], len(points) / (most + 1)
    target, seen = stride, counts[0]
    for k in range(1, len(values)):
        before, seen = seen, seen + counts[k]
        if abs(before - target) < abs(seen - target):
            found.append(middle[k - 1])
            target += stride
    return np.array(found)


def _bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """(rows, features): how many limits are below each value."""
    if not np.isfinite(x).all():
        raise ValueError("features must not be NaN or infinite")
    out = np.empty(x.shape, np.uint8)
    for k, cut in enumerate(cuts):
        out[:, k] = np.searchsorted(cut, x[:, k])
    return out


def _matrix(batch: pa.RecordBatch, column: str, inputs: int) -> np.ndarray:
    rows = batch.column(column)
    if rows.null_count:
        raise ValueError("features must not be null")
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, inputs)


def _batch(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _binary(*arrays: np.ndarray) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())


# --- growing one tree in a task -------------------------------------------------------------------


def _best_cuts(bin_of: np.ndarray, node: np.ndarray, y: np.ndarray, w: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For one feature of each node, the best purity of a split in two and the last bin on its left.

    Purity is the sum over both sides of squared class weights by weight; it is greatest where the
    Gini impurity is least. Without a split it is minus one."""
    n, k = totals.shape
    score, cut = np.full(n, -1.0), np.zeros(n, np.int64)
    if len(node) >= DENSE * n * BINS:
        cells = np.bincount((node * BINS + bin_of) * k + y, w, n * BINS * k).reshape(n, BINS, k)
        left = np.cumsum(cells, axis=1)[:, :-1]
        right = totals[:, None] - left
        a, b = left.sum(axis=2), right.sum(axis=2)
        with np.errstate(divide="ignore", invalid="ignore"):
            purity = np.where((a > 0) & (b > 0), (left * left).sum(axis=2) / a + (right * right).sum(axis=2) / b, -1.0)
        cut = purity.argmax(axis=1)
        return purity[np.arange(n), cut], cut
    # Sorted by node and bin, with class and weight in the same number.
    packed = np.sort(((node * BINS + bin_of) * k + y) << 8 | w)
    weight, key = packed & 255, packed >> 8
    run, label = key // k, key % k
    ends = np.flatnonzero(run[1:] != run[:-1])
    ends = ends[run[ends] // BINS == run[ends + 1] // BINS]
    if not len(ends):
        return score, cut
    at = run[ends] // BINS
    a = b = purity = 0.0
    sums = []
    for c in range(k):
        before = np.cumsum(totals[:, c]) - totals[:, c]
        left = np.cumsum(np.where(label == c, weight, 0))[ends] - before[at]
        sums.append((left, totals[at, c] - left))
        a, b = a + sums[-1][0], b + sums[-1][1]
    purity = sum(left * left for left, _ in sums) / a + sum(right * right for _, right in sums) / b
    starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    top = np.maximum.reduceat(purity, starts)
    hit = np.flatnonzero(purity == np.repeat(top, np.diff(np.append(starts, len(at)))))
    hit = hit[np.append(True, at[hit[1:]] != at[hit[:-1]])]
    score[at[hit]], cut[at[hit]] = top, run[ends[hit]] % BINS
    return score, cut


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, classes: int, tried: int, depth: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """One tree over binned rows (class ``y``, taken ``w`` times): at each node ``tried`` features, the
    split with the greatest gain in Gini impurity, until a node is pure, has no gain, or is ``depth`` deep.
    Two leaves of one parent that name the same class become one."""
    taken = np.flatnonzero(w)
    x, y, w = x[taken], y[taken].astype(np.int64), w[taken].astype(np.int64)
    totals = np.bincount(y, w, classes)[None]
    counts, left, feature, cuts = [totals], [np.array([-1])], [np.array([0])], [np.array([0])]
    ids, begin = np.array([0]), 1
    rows, node = np.arange(len(y)), np.zeros(len(y), np.int64)
    levels = [0, 1]
    for _ in range(depth):
        # Only nodes of more than one class go on.
        mixed = np.flatnonzero((totals > 0).sum(axis=1) > 1)
        if not len(mixed):
            break
        place = np.full(len(totals), -1)
        place[mixed] = np.arange(len(mixed))
        node = place[node]
        rows, node = rows[node >= 0], node[node >= 0]
        totals, ids = totals[mixed], ids[mixed]
        picks = np.argsort(rng.random((len(totals), x.shape[1])), axis=1)[:, :tried]
        score, chosen, cut = np.full(len(totals), -1.0), np.zeros(len(totals), np.int64), np.zeros(len(totals), np.int64)
        for j in range(picks.shape[1]):
            found, where = _best_cuts(x[rows, picks[node, j]].astype(np.int64), node, y[rows], w[rows], totals)
            better = found > score
            score[better], chosen[better], cut[better] = found[better], picks[better, j], where[better]
        gain = score > (totals * totals).sum(axis=1) / totals.sum(axis=1) * (1 + 1e-12)
        split = np.flatnonzero(gain)
        if not len(split):
            break
        place = np.full(len(totals), -1)
        place[split] = np.arange(len(split))
        kept = gain[node]
        rows, node = rows[kept], node[kept]
        node = 2 * place[node] + (x[rows, chosen[node]] > cut[node])
        whole = np.concatenate(left)
        whole[ids[split]] = begin + 2 * np.arange(len(split))
        left = [whole]
        for parts, values in ((feature, chosen), (cuts, cut)):
            parts[:] = [np.concatenate(parts)]
            parts[0][ids[split]] = values[split]
        totals = np.bincount(node * classes + y[rows], w[rows], 2 * len(split) * classes).reshape(-1, classes)
        ids = begin + np.arange(len(totals))
        begin += len(totals)
        counts.append(totals)
        left.append(np.full(len(totals), -1))
        feature.append(np.zeros(len(totals), np.int64))
        cuts.append(np.zeros(len(totals), np.int64))
        levels.append(begin)
    return _tree(np.concatenate(counts), np.concatenate(left), np.concatenate(feature), np.concatenate(cuts), levels)


def _tree(counts: np.ndarray, left: np.ndarray, feature: np.ndarray, cuts: np.ndarray, levels: list[int]) -> dict[str, np.ndarray]:
    says = counts.argmax(axis=1)
    for a, b in zip(levels[-2::-1], levels[:0:-1]):
        inner = a + np.flatnonzero(left[a:b] >= 0)
        one, two = left[inner], left[inner] + 1
        left[inner[(left[one] < 0) & (left[two] < 0) & (says[one] == says[two])]] = -1
    used = np.zeros(len(left), bool)
    used[0] = True
    for a, b in zip(levels[:-1], levels[1:]):
        inner = a + np.flatnonzero((left[a:b] >= 0) & used[a:b])
        used[left[inner]] = used[left[inner] + 1] = True
    number = np.cumsum(used) - 1
    left, feature, cuts, counts = left[used], feature[used], cuts[used], counts[used]
    leaf = left < 0
    left[~leaf] = number[left[~leaf]]
    left[leaf] = -1 - np.arange(leaf.sum())
    total = counts[leaf].sum(axis=1, keepdims=True)
    return {"feature": feature.astype(np.int16), "bin": cuts.astype(np.uint8), "left": left.astype(np.int32), "share": counts[leaf] / np.maximum(total, 1)}


def leaves(tree: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The number of the leaf of each row: minus one and that number stands in ``left``."""
    out, rows, at = np.zeros(len(x), np.int64), np.arange(len(x)), np.zeros(len(x), np.int64)
    while True:
        after = tree["left"][at]
        ended = after < 0
        out[rows[ended]] = -1 - after[ended]
        rows, at, after = rows[~ended], at[~ended], after[~ended]
        if not len(rows):
            return out
        at = after + (x[rows, tree["feature"][at]] > tree["bin"][at])


# --- the upper part of large trees ----------------------------------------------------------------


@dataclass
class Top:
    """A tree as far as nodes have more rows than a unit. Its leaves are units, or ``closed`` with class weights."""

    feature: list[int] = field(default_factory=lambda: [0])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    closed: dict[int, list[float]] = field(default_factory=dict)

    def nodes(self, x: np.ndarray) -> np.ndarray:
        """The leaf node of each row."""
        left = np.array(self.left)
        number = np.where(left < 0, -1 - np.arange(len(left)), left)
        return leaves({"feature": np.array(self.feature), "bin": np.array(self.bin), "left": number}, x)

    def split(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        at = len(self.left)
        self.feature[node], self.bin[node], self.left[node] = feature, cut, at
        for values, new in ((self.feature, 0), (self.bin, 0), (self.left, -1), (self.depth, self.depth[node] + 1)):
            values += [new, new]
        return at, at + 1

    def units(self) -> list[int]:
        return [k for k, after in enumerate(self.left) if after < 0 and k not in self.closed]


@dataclass(frozen=True)
class Shards:
    """Written rows: ``(part, number, n, bins, label)``, bins and labels as bytes."""

    frame: DataFrame
    rows: int
    inputs: int
    classes: int
    cuts: list[np.ndarray]
    seed: int


def _taken(seed: int, part: int, number: int, n: int, tree: int) -> np.ndarray:
    """How often a tree takes each row of a shard."""
    return np.minimum(np.random.default_rng((abs(seed), tree, part, number)).poisson(1.0, n), 255).astype(np.uint8)


def shards(df: DataFrame, seed: int) -> Shards:
    """Bin and pack the ``features`` (an ML vector) and the ``label`` of all rows."""
    spark = df.sparkSession
    rows = written(df.select(F.xxhash64(*[F.col(c) for c in df.columns if c != "features"], vector_to_array("features")).alias("h"), F.col("label").cast("double").alias("label"), vector_to_array("features").alias("x")), "forest-rows")
    found = rows.agg(F.count(F.lit(1)), F.max(F.size("x")), F.max("label"), F.count("label")).first()
    n, inputs, highest, labelled = found
    if not n:
        raise ValueError("a forest needs at least one row")
    if labelled < n:
        raise ValueError("labels must not be null")
    points = min(n, POINTS)
    # To half a point, so a table of so many rows is gone through exactly.
    places = F.lit((np.arange(points) + 0.5) / points)
    sorted_points = rows.agg(*[F.percentile_approx(F.col("x")[k], places, 2 * POINTS) for k in range(inputs)]).first()
    cuts = [limits(p, min(BINS, n) - 1) for p in sorted_points]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(b for b in batches if b.num_rows):
            label = batch.column("label").to_numpy(zero_copy_only=False)
            if (label != np.floor(label)).any() or (label < 0).any():
                raise ValueError("labels must be whole numbers from 0")
            bins = _bins(_matrix(batch, "x", inputs), cuts)
            yield _batch(part=pa.array([part], pa.int32()), number=pa.array([number], pa.int32()), n=pa.array([len(label)], pa.int32()), bins=_binary(bins), label=_binary(label.astype(np.uint8)))

    parts = -(-n // SHARD_ROWS)
    # The order of the rows follows from their values, so that trees do.
    packed = rows.repartition(parts, "h").sortWithinPartitions("h").mapInArrow(pack, "part int, number int, n int, bins binary, label binary")
    return Shards(written(packed.coalesce(min(parts, 2 * int(spark.sparkContext.defaultParallelism))), "forest-shards"), n, inputs, max(2, int(highest) + 1), cuts, seed)


def _shard(batch: pa.RecordBatch, k: int, inputs: int) -> tuple[np.ndarray, np.ndarray]:
    bins = np.frombuffer(batch.column("bins")[k].as_buffer(), np.uint8).reshape(-1, inputs)
    return bins, np.frombuffer(batch.column("label")[k].as_buffer(), np.uint8)


def _split_level(data: Shards, tops: list[Top], open_: list[tuple[int, int]], picks: np.ndarray) -> dict[int, np.ndarray]:
    """For each open node (tree, node): chosen feature, bin, gain or not, then class weights and rows of both sides."""
    inputs, classes, seed = data.inputs, data.classes, data.seed
    shipped = data.frame.sparkSession.sparkContext.broadcast(([vars(t) for t in tops], open_, picks))
    tried = picks.shape[1]
    shape = (tried, BINS, classes + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops, open_, picks = shipped.value
        tops = [Top(**t) for t in tops]
        by_tree: dict[int, list[int]] = {}
        for slot, (tree, _) in enumerate(open_):
            by_tree.setdefault(tree, []).append(slot)
        sums = np.zeros((len(open_), *shape))
        for batch in batches:
            for k in range(batch.num_rows):
                x, y = _shard(batch, k, inputs)
                part, number = batch.column("part")[k].as_py(), batch.column("number")[k].as_py()
                for tree, slots in by_tree.items():
                    w, at = _taken(seed, part, number, len(y), tree), tops[tree].nodes(x)
                    for slot in slots:
                        rows = np.flatnonzero((at == open_[slot][1]) & (w > 0))
                        for j in range(tried):
                            key = x[rows, picks[slot, j]].astype(np.int64)
                            for c in range(classes):
                                sums[slot, j, :, c] += np.bincount(key, w[rows] * (y[rows] == c), BINS)
                            sums[slot, j, :, classes] += np.bincount(key, minlength=BINS)
        yield _batch(slot=pa.array(range(len(open_)), pa.int32()), data=_binary(*sums))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, part in zip(batch.column("slot").to_pylist(), batch.column("data").to_pylist(), strict=True):
                part = np.frombuffer(part).reshape(shape)
                sums[slot] = sums[slot] + part if slot in sums else part
        picks = shipped.value[2]
        for slot, cells in sums.items():
            left = np.cumsum(cells, axis=1)[:, :-1]
            right = cells.sum(axis=1, keepdims=True) - left
            a, b = left[..., :classes], right[..., :classes]
            with np.errstate(divide="ignore", invalid="ignore"):
                purity = np.where((a.sum(axis=2) > 0) & (b.sum(axis=2) > 0), (a * a).sum(axis=2) / a.sum(axis=2) + (b * b).sum(axis=2) / b.sum(axis=2), -1.0)
            j, cut = np.unravel_index(purity.argmax(), purity.shape)
            whole = cells[0, :, :classes].sum(axis=0)
            gain = purity[j, cut] > (whole * whole).sum() / whole.sum() * (1 + 1e-12)
            found = np.concatenate([[picks[slot, j], cut, gain], left[j, cut], right[j, cut]])
            yield _batch(slot=pa.array([slot], pa.int32()), data=_binary(found))

    schema = "slot int, data binary"
    cores = int(data.frame.sparkSession.sparkContext.defaultParallelism)
    out = data.frame.mapInArrow(count, schema).repartition(min(len(open_), cores), "slot").mapInArrow(choose, schema)
    found = {r.slot: np.frombuffer(r.data) for r in out.collect()}
    shipped.destroy()
    return found


def upper_trees(data: Shards, trees: int, tried: int, depth: int, unit_rows: int) -> list[Top]:
    """The nodes of all trees that have more rows than a unit, split level by level."""
    tops = [Top() for _ in range(trees)]
    open_ = [(t, 0) for t in range(trees)] if data.rows > unit_rows else []
    classes = data.classes
    while open_:
        picks = np.array([np.random.default_rng((abs(data.seed), tree, node, 1)).permutation(data.inputs)[:tried] for tree, node in open_])
        found, after = _split_level(data, tops, open_, picks), []
        for slot, (tree, node) in enumerate(open_):
            feature, cut, gain = found[slot][:3]
            sides = found[slot][3:].reshape(2, classes + 1)
            top = tops[tree]
            if not gain or top.depth[node] >= depth:
                top.closed[node] = sides[:, :classes].sum(axis=0).tolist()
                continue
            for child, side in zip(top.split(node, int(feature), int(cut)), sides):
                if (side[:classes] > 0).sum() < 2:
                    top.closed[child] = side[:classes].tolist()
                elif side[classes] > unit_rows:
                    after.append((tree, child))
        open_ = after
    return tops


# --- all trees ------------------------------------------------------------------------------------


def _units(data: Shards, tops: list[Top], unit_rows: int) -> tuple[DataFrame, list[list[tuple[int, int]]]]:
    """Rows ``(unit, part, number, n, bins, label, w)`` and what each unit grows, as (tree, node). Trees over the
    whole table are dealt to units and draw for themselves; other units have one node and its rows."""
    spark = data.frame.sparkSession
    cores = int(spark.sparkContext.defaultParallelism)
    if data.rows <= unit_rows:
        tasks = min(len(tops), 4 * cores)
        units = [[(t, 0) for t in range(k, len(tops), tasks)] for k in range(tasks)]
        frame = data.frame.select(F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("unit"), "*", F.lit(None).cast("binary").alias("w"))
        return frame.repartitionById(tasks, "unit"), units
    units = [[(t, node)] for t, top in enumerate(tops) for node in top.units()]
    inputs, seed = data.inputs, data.seed
    shipped = spark.sparkContext.broadcast(([vars(t) for t in tops], units))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops, units = shipped.value
        tops = [Top(**t) for t in tops]
        by_tree: dict[int, list[tuple[int, int]]] = {}
        for unit, ((tree, node),) in enumerate(units):
            by_tree.setdefault(tree, []).append((unit, node))
        for batch in batches:
            for k in range(batch.num_rows):
                x, y = _shard(batch, k, inputs)
                part, number = batch.column("part")[k].as_py(), batch.column("number")[k].as_py()
                for tree, below in by_tree.items():
                    w, at = _taken(seed, part, number, len(y), tree), tops[tree].nodes(x)
                    sets = [np.flatnonzero((at == node) & (w > 0)) for _, node in below]
                    yield _batch(
                        unit=pa.array([u for u, _ in below], pa.int32()),
                        part=pa.array([part] * len(below), pa.int32()),
                        number=pa.array([number] * len(below), pa.int32()),
                        n=pa.array([len(s) for s in sets], pa.int32()),
                        bins=_binary(*[x[s] for s in sets]),
                        label=_binary(*[y[s] for s in sets]),
                        w=_binary(*[w[s] for s in sets]),
                    )

    frame = data.frame.mapInArrow(deal, "unit int, part int, number int, n int, bins binary, label binary, w binary")
    tasks = min(max(len(units), 1), 4 * cores)
    return frame.where("n > 0").repartitionById(tasks, F.col("unit") % tasks), units


def fit(df: DataFrame, trees: int, max_depth: int = 30, seed: int = 99, unit_rows: int | None = None) -> ForestModel:
    """A forest on ``features`` and ``label``: each tree learns from all rows, drawn with replacement, and tries
    the square root of the features' number at each node."""
    spark, unit_rows = df.sparkSession, unit_rows or UNIT_ROWS
    data = shards(df, seed)
    tried = int(np.ceil(np.sqrt(data.inputs)))
    tops = upper_trees(data, trees, tried, max_depth, unit_rows)
    frame, units = _units(data, tops, unit_rows)
    inputs, classes = data.inputs, data.classes
    shipped = spark.sparkContext.broadcast((units, [t.depth for t in tops]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, depths = shipped.value

        def grown(unit: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
            x, y = np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held])
            for tree, node in units[unit]:
                w = np.concatenate([_taken(seed, part, number, len(label), tree) if given is None else given for part, number, _, label, given in held])
                if w.any():
                    found = grow(x, y, w, classes, tried, max_depth - depths[tree][node], np.random.default_rng((abs(seed), tree, node, 2)))
                else:
                    # A tree that took no row knows nothing.
                    found = {"feature": np.zeros(1, np.int16), "bin": np.zeros(1, np.uint8), "left": np.full(1, -1, np.int32), "share": np.full((1, classes), 1.0 / classes)}
                yield _batch(tree=pa.array([tree], pa.int32()), node=pa.array([node], pa.int32()), **{c: _binary(found[c]) for c in NODES})

        now, held = -1, []
        for batch in batches:
            for k in range(batch.num_rows):
                unit = batch.column("unit")[k].as_py()
                if unit != now and held:
                    yield from grown(now, held)
                    held = []
                now = unit
                given = batch.column("w")[k]
                held.append((batch.column("part")[k].as_py(), batch.column("number")[k].as_py(), *_shard(batch, k, inputs), np.frombuffer(given.as_buffer(), np.uint8) if given.is_valid else None))
        if held:
            yield from grown(now, held)

    path = scratch_path(spark, "forest")
    frame.sortWithinPartitions("unit", "part", "number").mapInArrow(task, _TREE).write.parquet(path)
    shipped.destroy()
    return ForestModel(path, _Plan(trees, inputs, classes, [c.tolist() for c in data.cuts], {t: top for t, top in enumerate(tops) if len(top.left) > 1 or top.closed}))


@dataclass
class _Plan:
    """What the driver knows of a forest."""

    trees: int
    inputs: int
    classes: int
    cuts: list[list[float]]
    tops: dict[int, Top]

    def to_json(self) -> str:
        return json.dumps({**vars(self), "tops": {t: vars(top) for t, top in self.tops.items()}})

    @classmethod
    def from_json(cls, said: str) -> _Plan:
        values = json.loads(said)
        tops = {int(t): Top(**{**v, "closed": {int(k): x for k, x in v["closed"].items()}}) for t, v in values.pop("tops").items()}
        return cls(**values, tops=tops)

    def limits(self) -> list[np.ndarray]:
        return [np.array(c) for c in self.cuts]

    def closed_votes(self, x: np.ndarray, tree: int, at: np.ndarray, votes: np.ndarray) -> None:
        for node, weights in self.tops[tree].closed.items():
            votes[at == node] += np.array(weights) / sum(weights)


def _unpacked(batch: pa.RecordBatch, k: int, classes: int) -> dict[str, np.ndarray]:
    tree = {c: np.frombuffer(batch.column(c)[k].as_buffer(), kind) for c, kind in NODES.items()}
    return {**tree, "share": tree["share"].reshape(-1, classes)}


def _votes(plan: _Plan, trees: list[tuple[int, int, dict[str, np.ndarray]]], x: np.ndarray) -> np.ndarray:
    """(rows, classes): the sum of the trees' shares. Parts of one tree come one after the other."""
    votes, now, at = np.zeros((len(x), plan.classes)), -1, None
    for tree, node, nodes in trees:
        if tree != now:
            now, at = tree, None
            if tree in plan.tops:
                at = plan.tops[tree].nodes(x)
                plan.closed_votes(x, tree, at, votes)
        if at is None:
            votes += nodes["share"][leaves(nodes, x)]
        else:
            rows = np.flatnonzero(at == node)
            votes[rows] += nodes["share"][leaves(nodes, x[rows])]
    return votes


class ForestModel(Transformer, MLWritable, MLReadable):
    """A grown forest: adds ``prediction`` and ``probability`` to rows with ``features``.

    Trees are dealt to tasks, and all rows, packed, go past each of them; a row's votes are then added up. On a stream, where
    rows can't meet a second time, each task has all trees."""

    def __init__(self, path: str | None = None, plan: _Plan | None = None):
        super().__init__()
        self.path, self.plan = path, plan

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_TREE).parquet(self.path)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if dataset.isStreaming:
            return _named(dataset.withColumn("_votes", self._row_votes(dataset.sparkSession)("features")))
        rows = written(dataset.withColumn("_row", F.monotonically_increasing_id()), "forest-scored")
        return _named(rows.join(self._summed(rows), "_row").drop("_row"))

    def _summed(self, rows: DataFrame) -> DataFrame:
        """``(_row, _votes)`` of all rows."""
        spark, plan = rows.sparkSession, self.plan
        inputs, classes = plan.inputs, plan.classes

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cuts = plan.limits()
            for batch in batches:
                if batch.num_rows:
                    ids = batch.column("_row").to_numpy()
                    yield _batch(shard=pa.array([ids[0]], pa.int64()), ids=_binary(ids), bins=_binary(_bins(_matrix(batch, "x", inputs), cuts)))

        packed = written(rows.select("_row", vector_to_array("features").alias("x")).mapInArrow(pack, "shard long, ids binary, bins binary"), "forest-packed")
        tasks = min(plan.trees, 4 * int(spark.sparkContext.defaultParallelism))
        # The parts of a tree are in one task; trees come before rows.
        trees = self.table(spark).select((F.col("tree") % tasks).alias("task"), F.lit(0).alias("kind"), "tree", "node", *NODES, *[F.lit(None).cast(t).alias(c) for c, t in (("shard", "long"), ("ids", "binary"), ("bins", "binary"))])
        shards_ = packed.select(F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task"), F.lit(1).alias("kind"), *[F.lit(None).cast("int").alias(c) for c in ("tree", "node")], *[F.lit(None).cast("binary").alias(c) for c in NODES], "shard", "ids", "bins")

        def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees: list[tuple[int, int, dict[str, np.ndarray]]] = []
            for batch in batches:
                kinds = batch.column("kind").to_numpy()
                for k in range(batch.num_rows):
                    if kinds[k] == 0:
                        trees.append((batch.column("tree")[k].as_py(), batch.column("node")[k].as_py(), _unpacked(batch, k, classes)))
                        continue
                    x = np.frombuffer(batch.column("bins")[k].as_buffer(), np.uint8).reshape(-1, inputs)
                    yield _batch(shard=batch.column("shard").slice(k, 1), task=batch.column("task").slice(k, 1), ids=batch.column("ids").slice(k, 1), votes=_binary(_votes(plan, trees, x)))

        both = trees.unionByName(shards_).repartitionById(tasks, "task").sortWithinPartitions("task", "kind", "tree", "node", "shard")
        votes = both.mapInArrow(vote, "shard long, task int, ids binary, votes binary")

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, ids, total = None, None, None

            def out() -> pa.RecordBatch:
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * classes, pa.int32()), pa.array(total))
                return _batch(_row=pa.array(ids), _votes=lists)

            for batch in batches:
                for k in range(batch.num_rows):
                    shard, part = batch.column("shard")[k].as_py(), np.frombuffer(batch.column("votes")[k].as_buffer())
                    if shard != now:
                        if now is not None:
                            yield out()
                        now, ids, total = shard, np.frombuffer(batch.column("ids")[k].as_buffer(), np.int64), part
                    else:
                        total = total + part
            if now is not None:
                yield out()

        # Sums are in the order of the tasks, so they come out the same each time.
        return written(votes.repartition("shard").sortWithinPartitions("shard", "task").mapInArrow(add, "_row long, _votes array<double>"), "forest-votes")

    def _row_votes(self, spark: SparkSession):
        plan = self.plan
        rows = self.table(spark).orderBy("tree", "node").toArrow()
        batch = rows.combine_chunks().to_batches()[0]
        shipped = spark.sparkContext.broadcast([(batch.column("tree")[k].as_py(), batch.column("node")[k].as_py(), _unpacked(batch, k, plan.classes)) for k in range(batch.num_rows)])

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def votes(x: pa.Array) -> pa.Array:
            values = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), plan.inputs)
            total = _votes(plan, shipped.value, _bins(values, plan.limits()))
            return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * plan.classes, pa.int32()), pa.array(total.ravel()))

        return lambda column: votes(vector_to_array(column))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


def _named(df: DataFrame) -> DataFrame:
    """The class with the most votes (the first of equals) and the shares of all."""
    total = F.aggregate("_votes", F.lit(0.0), lambda a, v: a + v)
    share: Column = F.transform("_votes", lambda v: v / F.col("_total"))
    best = (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double")
    return df.withColumn("_total", total).withColumns({"prediction": best, "probability": array_to_vector(share)}).drop("_votes", "_total")


class _Writer(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(self.model, path, spark, extraMetadata={"plan": self.model.plan.to_json()})
        self.model.table(spark).write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def load(self, path: str) -> ForestModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = ForestModel(f"{path}/trees", _Plan.from_json(metadata["plan"]))
        model._resetUid(metadata["uid"])
        return model
