"""Toxicity: a convolutional text classifier over hashed words, trained by numpy in tasks.

All labelled rows are dealt to workers by a hash of their id and written once. In a round each worker
goes through its rows in mini-batches from the common weights, and the means of their weights are the
next common ones; thresholds come from running totals over all calibration rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinscope.llm.components import written
from twinscope.llm.linededup import maybe_in
from twinscope.llm.textbytes import ALPHANUMERIC, buffers, hash_words, slices
from twinscope.operators.ranking import with_running_totals
from twinscope.operators.sampling import with_folds

#: Word buckets (the last one pads), numbers per word, filter widths and filters of each.
BUCKETS, DIM, WIDTHS, FILTERS = 1 << 17, 8, (1, 2, 3), 8
PAD = BUCKETS
#: A word's numbers are the sum of those of the word and of its beginnings of so many bytes,
#: as endings vary by inflection.
HEADS = (4, 6)
#: Rows of a worker at least; the number of workers follows the labelled rows.
WORKER_ROWS = 4000
#: Text bytes of a worker that are mixed and dealt to mini-batches at a time.
POOL_BYTES = 8 << 20
#: Word buckets whose weights are added up at a time.
SLOT = 1 << 13
#: Epochs between two meetings of the workers: what they send is the largest shuffle.
MEET = 2
EPOCHS, BATCH, RATE, DECAY = 8, 64, 0.05, 1e-4
#: Steps of a worker at least; few rows are gone through more often.
LEAST_STEPS = 500
#: Buckets of words that fewer texts of the fit hold stay at zero, as unseen words do.
MIN_TEXTS = 5
#: Documents whose score reaches this are predicted toxic.
CUT = 0.7
#: Calibration rows of each class that a language needs for a threshold of its own.
LANGUAGE_ROWS = 30


def word_ids(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and their beginnings, a row per word; where each text begins.

    Each text is followed by pads for the widest filter.
    """
    words, at, *heads = hash_words(data, offsets, ALPHANUMERIC, HEADS)
    pads = max(WIDTHS)
    n = np.diff(at)
    begins = np.concatenate([[0], np.cumsum(n + pads)])
    ids = np.full((begins[-1], 1 + len(HEADS)), PAD, np.int32)
    place = np.arange(len(words)) + np.repeat(np.arange(len(n)) * pads, n)
    for k, hashes in enumerate((words, *heads)):
        ids[place, k] = (hashes & np.uint64(BUCKETS - 1)).astype(np.int32)
    return ids, begins


@dataclass
class Net:
    """Weights, the logit that scores ``CUT``, and thresholds by language."""

    embedding: np.ndarray
    filters: list[np.ndarray]  # by width: (width, DIM, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    out_bias: float = 0.0
    centre: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def logits(self, ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Largest filter responses of each text, weighted."""
        if len(begins) < 2:
            return np.zeros(0)
        words = self.embedding[ids].sum(axis=1)
        parts = []
        for w, kernel in zip(WIDTHS, self.filters, strict=True):
            got = words @ kernel[0]
            for j in range(1, w):
                got[:-j] += words[j:] @ kernel[j]
                # A filter that starts here would run into the next text.
                got[begins[1:] - j] = -np.inf
            # The pads that end a text also stand for a text without words.
            parts.append(np.maximum.reduceat(got, begins[:-1], axis=0))
        return (np.hstack(parts) + self.bias) @ self.out + self.out_bias

    def scores(self, logits: np.ndarray) -> np.ndarray:
        shifted = np.clip(logits.astype(np.float64) - self.centre + np.log(CUT / (1 - CUT)), -30, 30)
        return 1 / (1 + np.exp(-shifted))


@dataclass
class Training:
    """A net, its sums of squared gradients (embedding, filters, out), and which buckets learn."""

    net: Net
    seen: list[np.ndarray]
    learns: np.ndarray

    @classmethod
    def start(cls, learns: np.ndarray, seed: int = 1) -> Training:
        """Embeddings begin near zero, and at zero for rare words, so words that say nothing are neutral."""
        rng = np.random.default_rng(seed)
        net = Net(
            rng.normal(0, 0.02, (BUCKETS + 1, DIM)).astype(np.float32),
            [rng.normal(0, 0.5, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
            np.zeros(len(WIDTHS) * FILTERS, np.float32),
            rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32),
        )
        net.embedding[~learns] = 0
        return cls(net, [np.full_like(a, 1e-2) for a in (net.embedding, *net.filters, net.out)], learns)

    def copy(self) -> Training:
        net = Net(self.net.embedding.copy(), [k.copy() for k in self.net.filters], self.net.bias.copy(), self.net.out.copy(), self.net.out_bias)
        return Training(net, [a.copy() for a in self.seen], self.learns)

    def dense(self) -> np.ndarray:
        """All but what belongs to buckets, as one vector."""
        net = self.net
        return np.concatenate([a.ravel() for a in (*net.filters, net.bias, net.out, np.array([net.out_bias]), *self.seen[1:])]).astype(np.float64)

    def set_dense(self, flat: np.ndarray) -> None:
        net, at = self.net, 0
        bias = np.zeros(1)
        for a in (*net.filters, net.bias, net.out, bias, *self.seen[1:]):
            a[...] = flat[at : at + a.size].reshape(a.shape)
            at += a.size
        net.out_bias = float(bias[0])

    def learn(self, texts: list[np.ndarray], toxic: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Go once through the texts (word buckets without pads) in mini-batches; the buckets that got a
        gradient. Logistic loss by Adagrad; only the words under each filter's maximum get one."""
        net, seen = self.net, self.seen
        touched_all = np.zeros(BUCKETS + 1, bool)
        pads = np.full((max(WIDTHS), 1 + len(HEADS)), PAD, np.int32)
        for batch in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // BATCH)):
            ids = np.concatenate([x for k in batch for x in (texts[k], pads)])
            begins = np.cumsum([0, *[len(texts[k]) + len(pads) for k in batch]])
            words = net.embedding[ids].sum(axis=1)
            where, values = [], []
            for w, kernel in zip(WIDTHS, net.filters, strict=True):
                got = words @ kernel[0]
                for j in range(1, w):
                    got[:-j] += words[j:] @ kernel[j]
                best = np.array([a + got[a : b - w + 1].argmax(axis=0) for a, b in zip(begins[:-1], begins[1:], strict=True)])
                where.append(best)
                values.append(np.take_along_axis(got, best, axis=0))
            feats = np.hstack(values) + net.bias
            p = 1 / (1 + np.exp(-np.clip(feats @ net.out + net.out_bias, -30, 30)))
            slope = ((p - toxic[batch]) / len(batch)).astype(np.float32)
            pull = slope[:, None] * net.out
            grads = [None, *[np.zeros_like(k) for k in net.filters]]
            touched, pushes = [], []
            for i, (w, kernel) in enumerate(zip(WIDTHS, net.filters, strict=True)):
                g = pull[:, i * FILTERS : (i + 1) * FILTERS]
                for j in range(w):
                    at = ids[where[i] + j]
                    grads[1 + i][j] += np.einsum("bf,bfd->df", g, words[where[i] + j])
                    push = np.repeat((g[:, :, None] * kernel[j].T[None]).reshape(-1, DIM), at.shape[-1], axis=0)
                    touched.append(at.reshape(-1))
                    pushes.append(push)
            grad_out = feats.T @ slope + DECAY * net.out
            rows, back = np.unique(np.concatenate(touched), return_inverse=True)
            g = DECAY * net.embedding[rows]
            np.add.at(g, back, np.concatenate(pushes))
            rows, g = rows[self.learns[rows]], g[self.learns[rows]]
            touched_all[rows] = True
            seen[0][rows] += g * g
            net.embedding[rows] -= RATE * g / np.sqrt(seen[0][rows])
            for i, kernel in enumerate(net.filters):
                g = grads[1 + i] + DECAY * kernel
                seen[1 + i] += g * g
                kernel -= RATE * g / np.sqrt(seen[1 + i])
            net.bias -= RATE * pull.sum(axis=0)
            seen[-1] += grad_out * grad_out
            net.out -= RATE * grad_out / np.sqrt(seen[-1])
            net.out_bias -= RATE * float(slope.sum())
        return touched_all


def _texts(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Word buckets of each text, without pads."""
    ids, begins = word_ids(*buffers(batch.column("text")))
    return [ids[a : b - max(WIDTHS)] for a, b in zip(begins[:-1], begins[1:], strict=True)]


def _pools(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """Worker, texts and labels of rows that come ordered by worker, a bounded number of bytes at a time."""
    worker, texts, toxic, size = None, [], [], 0
    for batch in slices(batches, "text"):
        workers = batch.column("worker").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(workers)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if texts and (workers[a] != worker or size >= POOL_BYTES):
                yield worker, texts, np.concatenate(toxic)
                texts, toxic, size = [], [], 0
            part = batch.slice(a, b - a)
            worker = int(workers[a])
            texts += _texts(part)
            toxic.append(part.column("toxic").to_numpy().astype(np.float64))
            size += pa.compute.sum(pa.compute.binary_length(part.column("text"))).as_py() or 0
    if texts:
        yield worker, texts, np.concatenate(toxic)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many of a task's texts hold each bucket."""
    n = np.zeros(BUCKETS + 1, np.int64)
    for batch in slices(batches, "text"):
        for text in _texts(batch):
            n[np.unique(text)] += 1
    held = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(n[held])], ["bucket", "n"])


def _round(shipped, epochs: range):
    """A task's workers, each from the common weights: sums of their weights by their rows, of a
    bucket over the workers that moved it."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, seen, learns = shipped.value
        common = Training(Net(**net), seen, learns)
        sums = np.zeros((BUCKETS + 1, 2 * DIM + 1), np.float32)
        dense, size, first, worker, own = 0.0, 0, None, None, None

        def finish() -> None:
            nonlocal dense, size
            moved = np.flatnonzero(touched)
            sums[moved] += np.float32(n) * np.hstack([own.net.embedding[moved], own.seen[0][moved], np.ones((len(moved), 1), np.float32)])
            dense, size = dense + n * own.dense(), size + n

        for number, texts, toxic in _pools(batches):
            if number != worker:
                if own is not None:
                    finish()
                own, worker, pool, n, touched = common.copy(), number, 0, 0, np.zeros(BUCKETS + 1, bool)
                first = number if first is None else first
            for epoch in epochs:
                touched |= own.learn(texts, toxic, np.random.default_rng((epoch, number, pool)))
            pool, n = pool + 1, n + len(texts)
        if own is None:
            return
        finish()
        slots, places, data = [-1], [b""], [np.append(dense, float(size)).tobytes()]
        for slot in range(-(-len(sums) // SLOT)):
            part = sums[slot * SLOT : (slot + 1) * SLOT]
            held = np.flatnonzero(part[:, -1])
            if len(held):
                slots.append(slot)
                places.append(held.astype(np.int32).tobytes())
                data.append(part[held].tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots, pa.int32()), pa.array([first] * len(slots), pa.int32()), pa.array(places, pa.binary()), pa.array(data, pa.binary())], _SUMS
        )

    return train


_SUMS = ["slot", "part", "places", "data"]
_SUMS_SCHEMA = "slot int, part int, places binary, data binary"


def _means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the tasks, ordered by slot, to one mean a slot."""
    slot, total = None, None

    def mean() -> pa.RecordBatch:
        if slot < 0:
            places, values = b"", total[:-1] / total[-1]
        else:
            held = np.flatnonzero(total[:, -1])
            places, values = held.astype(np.int32).tobytes(), (total[held, :-1] / total[held, -1:]).astype(np.float32)
        return pa.RecordBatch.from_arrays(
            [pa.array([slot], pa.int32()), pa.array([0], pa.int32()), pa.array([places], pa.binary()), pa.array([values.tobytes()], pa.binary())], _SUMS
        )

    for batch in batches:
        for k, places, data in zip(*(batch.column(c).to_pylist() for c in ("slot", "places", "data")), strict=True):
            if slot is not None and k != slot:
                yield mean()
            values = np.frombuffer(data, np.float64 if k < 0 else np.float32)
            if k != slot:
                slot, total = k, np.zeros(len(values)) if k < 0 else np.zeros((SLOT, 2 * DIM + 1))
            if k < 0:
                total += values
            else:
                total[np.frombuffer(places, np.int32)] += values.reshape(-1, 2 * DIM + 1)
    if slot is not None:
        yield mean()


def _one_round(rows: DataFrame, state: Training, epochs: range) -> None:
    """Train all workers and set the common weights to their means; the driver gets one net."""
    context = rows.sparkSession.sparkContext
    # Plain values are broadcast: the executors needn't have this package.
    shipped = context.broadcast((dict(vars(state.net)), state.seen, state.learns))
    # A task sends one sum of all its workers, so that a round moves as many nets as there are cores at most.
    dealt = rows.select("worker", "toxic", "text").coalesce(context.defaultParallelism)
    sums = dealt.mapInArrow(_round(shipped, epochs), _SUMS_SCHEMA)
    slots = 2 + BUCKETS // SLOT
    means = sums.repartition(min(slots, context.defaultParallelism), "slot").sortWithinPartitions("slot", "part").mapInArrow(_means, _SUMS_SCHEMA)
    found = means.collect()
    shipped.destroy()
    for r in found:
        if r.slot < 0:
            state.set_dense(np.frombuffer(r.data))
        else:
            held = np.frombuffer(r.places, np.int32) + r.slot * SLOT
            values = np.frombuffer(r.data, np.float32).reshape(-1, 2 * DIM)
            state.net.embedding[held], state.seen[0][held] = values[:, :DIM], values[:, DIM:]


def fit(rows: DataFrame, n: int, n_bytes: int, workers: int) -> Net:
    """Train on ``rows`` (worker, toxic, text), which come ordered by worker. Buckets of words that
    fewer than ``MIN_TEXTS`` texts hold stay at zero. A table of one pool needs one job."""
    known = rows.select("text").mapInArrow(_buckets, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    learns = np.zeros(BUCKETS + 1, bool)
    # At most as many rows as there are buckets.
    learns[[r.bucket for r in known.where(F.col("n") >= MIN_TEXTS).select("bucket").collect()]] = True
    learns[PAD] = False
    state = Training.start(learns)
    epochs = max(EPOCHS, -(-LEAST_STEPS // max(1, n // workers // BATCH)))
    at_once = epochs if workers == 1 and n_bytes <= POOL_BYTES else MEET
    for at in range(0, epochs, at_once):
        _one_round(rows, state, range(at, min(at + at_once, epochs)))
    return state.net


def best_thresholds(scored: DataFrame) -> dict[str, float]:
    """By ``group``: the ``value`` with the best F1 of those over which half are ``toxic`` at least, in the
    middle of the gap under it; above all values if there is none. Over all rows, by running totals."""
    per = scored.groupBy("group", "value").agg(F.sum("toxic").cast("long").alias("t"), F.count(F.lit(1)).alias("n"))
    totals = {"hit": F.col("t"), "said": F.col("n")}
    running = with_running_totals(per, [F.col("group"), F.col("value").desc()], totals)
    # One row per group.
    before = running.groupBy("group").agg(
        F.min(F.col("hit") - F.col("t")).alias("_hit"), F.min(F.col("said") - F.col("n")).alias("_said"), F.sum("t").alias("all"), F.max("value").alias("top")
    )
    own = running.join(F.broadcast(before), "group").withColumns({"hit": F.col("hit") - F.col("_hit"), "said": F.col("said") - F.col("_said")})
    f1 = F.when(2 * F.col("hit") >= F.col("said"), 2 * F.col("hit") / (F.col("said") + F.col("all")))
    best = own.where(f1.isNotNull()).groupBy("group").agg(F.max(F.struct(f1.alias("f1"), "value")).alias("best"))
    chosen = before.select("group", "top").join(best, "group", "left").select("group", "top", F.col("best.value").alias("v"))
    below = per.join(F.broadcast(chosen), "group").groupBy("group", "top", "v").agg(F.max(F.when(F.col("value") < F.col("v"), F.col("value"))).alias("below"))
    cut = F.coalesce((F.col("v") + F.coalesce("below", F.col("v") - 1)) / 2, F.col("top") + 1)
    return {r.group: r.cut for r in below.select("group", cut.alias("cut")).collect()}


def _labelled(docs: DataFrame, labels: DataFrame, text: str, ident: str) -> DataFrame:
    """All labelled documents, in files ordered by worker."""
    known = labels.where(F.col("toxic").isNotNull() & F.col(ident).isNotNull()).groupBy(F.col(ident).alias("_id")).agg(F.max("toxic").alias("_toxic"))
    known = known.where(F.col("_toxic").isin(0, 1)).select("_id", F.col("_toxic").cast("int").alias("toxic"))
    folds = with_folds(known, "toxic", "_id", 5, 99)
    known = written(folds.select("_id", "toxic", (F.col("fold") == 0).alias("held")), "labels")
    n = known.count()
    workers = max(1, n // WORKER_ROWS)
    lang = F.coalesce("lang", F.lit("")) if "lang" in docs.columns else F.lit("")
    texts = docs.select(F.col(ident).alias("_id"), lang.alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    # Texts without a label aren't moved, the others once: labels come to them as rows of their own,
    # since a shuffled join would be followed by the move to the workers.
    labelled = known.withColumns({"lang": F.lit(""), "text": F.lit(None).cast("string")})
    rows = labelled.unionByName(maybe_in(texts, known, "_id", n), allowMissingColumns=True)
    placed = rows.withColumns(
        {
            "worker": F.pmod(F.xxhash64(F.lit(17), "_id"), F.lit(workers)).cast("int"),
            "place": F.xxhash64(F.lit(11), "_id"),
        }
    ).repartition(workers, "worker")
    # A label's row has no text and comes first.
    own = Window.partitionBy("worker", "place", "_id").orderBy(F.col("text").asc_nulls_first(), "lang").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumns({c: F.max(c).over(own) for c in ("toxic", "held")}).where("text is not null and toxic is not null")
    order = ["worker", "place", "_id", "text", "lang"]
    return written(placed.sortWithinPartitions(*order).select("worker", "held", "toxic", "lang", "text"), "labelled")


def train(docs: DataFrame, labels: DataFrame, text: str = "text", ident: str = "doc_id") -> Net | None:
    """Fit on four fifths of all labelled rows of each class, by a hash of the id, calibrate on the others.

    ``labels`` has ``ident`` and ``toxic`` (null: not labelled). Whole texts are used. The
    logit with the best F1 over all languages is mapped to a score of ``CUT``; each language with
    enough calibration rows also gets its own threshold. Without rows of both classes: None.
    """
    rows = _labelled(docs, labels, text, ident)
    sizes = rows.groupBy("held").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("toxic").alias("toxic"),
        F.sum(F.octet_length("text")).alias("n_bytes"),
        F.countDistinct("worker").alias("workers"),
    )
    # Two rows at most.
    sizes = {r.held: r for r in sizes.collect()}
    if not 0 < sum(r.toxic for r in sizes.values()) < sum(r.n for r in sizes.values()):
        return None
    fit_rows, held = rows.where("not held"), rows.where("held")
    parts = [sizes[False]] if False in sizes else []
    if not all(k in sizes and 0 < sizes[k].toxic < sizes[k].n for k in (False, True)):
        fit_rows, held, parts = rows, rows, list(sizes.values())
    net = fit(fit_rows, sum(r.n for r in parts), sum(r.n_bytes for r in parts), max(r.workers for r in parts))
    shipped = rows.sparkSession.sparkContext.broadcast(dict(vars(net)))
    schema = "lang string, toxic int, value double"
    logits = written(held.select("lang", "toxic", "text").mapInArrow(_logits(shipped), schema), "logits")
    net.centre = best_thresholds(logits.withColumn("group", F.lit("")))[""]
    both = logits.groupBy("lang").agg(F.count_if(F.col("toxic") == 1).alias("ones"), F.count_if(F.col("toxic") == 0).alias("zeros"))
    # One row per language.
    enough = both.where((F.col("ones") >= LANGUAGE_ROWS) & (F.col("zeros") >= LANGUAGE_ROWS)).select(F.col("lang").alias("group"))
    own = logits.withColumnRenamed("lang", "group").join(F.broadcast(enough), "group")
    for lang, logit in sorted(best_thresholds(own).items()):
        net.thresholds[lang] = float(net.scores(np.array([logit]))[0])
    return net


def _logits(net):
    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Net(**net.value)
        for batch in slices(batches, "text"):
            values = own.logits(*word_ids(*buffers(batch.column("text")))).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("toxic"), pa.array(values)], ["lang", "toxic", "value"])

    return logits


def _score(net, text: str, columns: list[str]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Plain values are broadcast: the executors needn't have this package.
        own = Net(**net.value)
        for batch in slices(batches, text):
            ids, begins = word_ids(*buffers(batch.column(text)))
            scores = own.scores(own.logits(ids, begins))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(scores)], [*columns, "score"])

    return score


def score_toxicity(docs: DataFrame, net: Net | None, text: str = "text", lang: str | None = "lang") -> DataFrame:
    """Rows of ``docs`` with ``score`` (0 to 1), ``threshold`` (its language's) and ``rejected``.

    The score comes from the text alone. A null or empty text is scored as one without words.
    Without a net (no rows of both classes to learn from) nothing is known: the score is 0.
    Columns of ``docs`` named like the added ones are replaced; an unknown language has the
    common threshold.
    """
    docs = docs.drop("score", "threshold", "rejected")
    common = F.lit(CUT)
    if net is None:
        return docs.withColumns({"score": F.lit(0.0), "threshold": common, "rejected": F.lit(False)})
    shipped = docs.sparkSession.sparkContext.broadcast(dict(vars(net)))
    scored = docs.mapInArrow(_score(shipped, text, docs.columns), docs.withColumn("score", F.lit(0.0)).schema)
    own = common
    if lang in docs.columns:
        own = F.coalesce(*[F.when(F.col(lang) == k, F.lit(v)) for k, v in net.thresholds.items()], common)
    return scored.withColumn("threshold", own).withColumn("rejected", F.col("score") >= F.col("threshold"))
