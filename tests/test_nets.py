"""The mini-batch trainer against finite differences, plain numpy nets and itself in parts."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from twinscope.plans import models, nets
from twinscope.plans.nets import Net


def dense_rows(x, y, fold):
    n = len(y)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
    rows = pa.StructArray.from_arrays([pa.array(range(n)), pa.array(y.astype(float)), pa.array(fold, pa.int32()), pa.array([f < 0 for f in fold]), lists], ["id", "label", "fold", "held", "x"])
    return nets.Rows(rows, None, 0)


def word_rows(seqs, vectors, y, fold):
    cuts = np.cumsum([0, *map(len, seqs)]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array([w for s in seqs for w in s], pa.int64()))
    rows = pa.StructArray.from_arrays([pa.array(range(len(y))), pa.array(y.astype(float)), pa.array(fold, pa.int32()), pa.array([f < 0 for f in fold]), lists], ["id", "label", "fold", "held", "x"])
    known = list(vectors)
    words = pa.StructArray.from_arrays([pa.array(known, pa.int64()), pa.array([list(vectors[w]) for w in known], pa.list_(pa.float32()))], ["idx", "vector"])
    return nets.Rows(rows, words, len(vectors[known[0]]))


@pytest.mark.parametrize("activation", ["relu", "tanh"])
@pytest.mark.parametrize("hidden", [(), (4,), (5, 3)])
def test_gradient_equals_finite_differences(activation, hidden):
    rng = np.random.default_rng(1)
    net = Net(hidden, activation)
    x, y = rng.standard_normal((7, 6)), rng.integers(0, 2, 7).astype(float)
    weights = nets.start_weights(net, 6, 3, float) + 0.1 * rng.standard_normal((3, nets.start_weights(net, 6, 1, float).size))
    mask = rng.random((3, 7)) < 0.7
    mask[:, 0] = True
    # The last two columns are missing in the batch, as with short texts.
    for part in (x, x[:, :4]):
        got = nets.gradient(net, 6, weights, part, y, mask)

        def loss(w):
            return (nets.losses(nets.forward(net, 6, w, part)[-1][:, :, 0], y) * mask).sum(axis=1) / mask.sum(axis=1)

        for j in range(weights.shape[1]):
            up, down = weights.copy(), weights.copy()
            up[:, j] += 1e-6
            down[:, j] -= 1e-6
            assert np.allclose((loss(up) - loss(down)) / 2e-6, got[:, j], atol=1e-6)


def test_words_are_looked_up_as_flat_vectors():
    rng = np.random.default_rng(2)
    vectors = {3: [1.0, 2.0], 9: [3.0, 4.0]}
    rows = word_rows([[3, 9, 7], [], [9]], vectors, np.array([0, 1, 1]), [0, 0, 1])
    assert rows.take(np.array([0, 1, 2])).tolist() == [[1, 2, 3, 4, 0, 0], [0] * 6, [3, 4, 0, 0, 0, 0]]
    assert rows.take(np.array([2])).tolist() == [[3, 4]]
    net = Net((3,), "tanh")
    weights = nets.start_weights(net, 8, 1, np.float32) + rng.standard_normal((1, 31)).astype(np.float32)
    padded = np.zeros((3, 8), np.float32)
    padded[:, :6] = rows.take(np.arange(3))
    assert np.allclose(nets.forward(net, 8, weights, padded)[-1], nets.forward(net, 8, weights, rows.take(np.arange(3)))[-1])


def plain_net(net, x, y, learn, epochs, orders):
    """One model, one row at a time, from the textbook."""
    shapes = net.sizes(x.shape[1])
    flat = nets.start_weights(net, x.shape[1], 1, float)[0]
    weights, at = [], 0
    for a, b in shapes:
        weights += [flat[at : at + a * b].reshape(a, b).copy(), flat[at + a * b : at + a * b + b].copy()]
        at += a * b + b
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    step, t = net.step if net.step is not None else {"sgd": 0.01, "rmsprop": 0.001, "adam": 0.001}[net.optimiser], 0
    act = (lambda z: np.maximum(z, 0)) if net.activation == "relu" else np.tanh
    slope = (lambda v: (v > 0).astype(float)) if net.activation == "relu" else (lambda v: 1 - v * v)
    for epoch in range(epochs):
        order = orders[epoch]
        for at in range(0, len(order), net.batch):
            rows = [i for i in order[at : at + net.batch] if learn[i]]
            sums = [np.zeros_like(w) for w in weights]
            for i in rows:
                values = [x[i]]
                for k in range(len(shapes)):
                    z = values[-1] @ weights[2 * k] + weights[2 * k + 1]
                    values.append(act(z) if k < len(shapes) - 1 else z)
                delta = 1 / (1 + np.exp(-values[-1])) - y[i]
                for k in reversed(range(len(shapes))):
                    sums[2 * k] += np.outer(values[k], delta) / len(rows)
                    sums[2 * k + 1] += delta / len(rows)
                    if k:
                        delta = (weights[2 * k] @ delta) * slope(values[k])
            t += 1
            for k, (w, g) in enumerate(zip(weights, sums)):
                m = moments[k]
                if net.optimiser == "sgd":
                    w -= step * g
                elif net.optimiser == "rmsprop":
                    m[1] = 0.9 * m[1] + 0.1 * g * g
                    w -= step * g / (np.sqrt(m[1]) + 1e-7)
                else:
                    m[0], m[1] = 0.9 * m[0] + 0.1 * g, 0.999 * m[1] + 0.001 * g * g
                    w -= step * (m[0] / (1 - 0.9**t)) / (np.sqrt(m[1] / (1 - 0.999**t)) + 1e-7)
                if k % 2 == 0:
                    w /= 1 + 2 * step * net.l2
                    w[:] = np.sign(w) * np.maximum(np.abs(w) - step * net.l1, 0)
    return np.concatenate([w.ravel() for w in weights])


@pytest.mark.parametrize("optimiser", ["sgd", "rmsprop", "adam"])
@pytest.mark.parametrize(("activation", "l1", "l2"), [("relu", 0.0, 0.0), ("tanh", 0.3, 0.1)])
def test_training_equals_a_plain_net(optimiser, activation, l1, l2):
    rng = np.random.default_rng(4)
    x, y, fold = rng.standard_normal((50, 5)), rng.integers(0, 2, 50).astype(float), rng.integers(-1, 3, 50)
    net = Net((6, 4), activation, optimiser, batch=8, l1=l1, l2=l2)
    state = nets.State.of(net, nets.start_weights(net, 5, 4, float))
    nets.run_epochs(net, 5, state, dense_rows(x, y, fold), range(6), worker=0)
    orders = [np.random.default_rng((net.seed, e, 0)).permutation(np.flatnonzero(fold >= 0)) for e in range(6)]
    for k in range(4):
        want = plain_net(net, x, y, (fold >= 0) & (fold != k), 6, orders)
        assert np.allclose(state.weights[k], want, rtol=1e-9, atol=1e-12)


def test_last_model_leaves_out_what_is_held_from_it(monkeypatch):
    """Folds of all rows, and a part of them held out of the last model."""
    monkeypatch.setattr(nets, "CACHED", 7)
    rng = np.random.default_rng(8)
    x, y, fold, held = rng.standard_normal((40, 3)), rng.integers(0, 2, 40).astype(float), np.arange(40) % 2, np.arange(40) % 4 == 3
    rows = dense_rows(x, y, fold)
    rows.held, rows.learning = held, np.arange(40)
    net = Net((4,), "tanh", "adam", batch=6)
    state = nets.State.of(net, nets.start_weights(net, 3, 3, float))
    seen = nets.run_epochs(net, 3, state, rows, range(3), worker=2)
    orders = [np.random.default_rng((net.seed, e, 2)).permutation(40) for e in range(3)]
    for k, learn in enumerate((fold != 0, fold != 1, ~held)):
        assert np.allclose(state.weights[k], plain_net(net, x, y, learn, 3, orders), rtol=1e-9, atol=1e-12)
    assert seen[0, :, 2].tolist() == [20, 20, 30] and seen[0, :, 5].tolist() == [20, 20, 10]


def test_soft_threshold_makes_zeros():
    rng = np.random.default_rng(6)
    x, y = rng.standard_normal((60, 5)), rng.integers(0, 2, 60).astype(float)
    net = Net((6,), "relu", "sgd", l1=5.0)
    state = nets.State.of(net, nets.start_weights(net, 5, 1, float))
    nets.run_epochs(net, 5, state, dense_rows(x, y, np.zeros(60, int) + 5), range(20), worker=0)
    assert all((kernel == 0).all() for kernel, _ in nets.layers(net, 5, state.weights))


def table(spark, n=600):
    corners = spark.range(n).select("id", (F.col("id") % 2).cast("double").alias("a"), (F.col("id") % 4 >= 2).cast("double").alias("b"))
    data = corners.withColumn("label", (F.col("a") != F.col("b")).cast("double"))
    fold = F.when(F.col("id") % 24 >= 20, -1).otherwise((F.floor(F.col("id") / 4) % 3).cast("int"))
    return models.assemble(data.withColumn("fold", fold).withColumn("held", F.col("fold") < 0), ["a", "b"])


def test_corners_of_a_square_are_learned_by_all_workers(spark, monkeypatch):
    net = Net((8,), "tanh", "adam", step=0.02)
    results = []
    for rows in (1000, 150):
        monkeypatch.setattr(nets, "WORKER_ROWS", rows)
        shards = nets.feature_shards(table(spark), 3)
        assert shards.workers == (1 if rows == 1000 else 4) and shards.frame.count() == shards.workers
        fitted = nets.fit(shards, net, 40)
        assert fitted.history.shape == (41, 4, 6) and (fitted.accuracies(40) == 1).all()
        assert (fitted.history[:, :-1, 2] + fitted.history[:, :-1, 5] == 500).all() and (fitted.history[:, -1, 5] == 100).all()
        out = nets.predictions(shards, fitted).collect()
        assert len(out) == 100 and all(r.label == r.prediction == int(r.probability > 0.5) for r in out)
        best = {r.part: r for r in nets.best_of_history(spark, fitted).collect()}
        assert set(best) == {"train", "validation"} and best["validation"].best_accuracy == 1
        assert best["train"].lowest_loss < 0.2 and 1 <= best["validation"].best_accuracy_epoch <= 40
        results.append(fitted)
    linear = nets.fit(shards, Net((), "tanh", "adam", step=0.02), 5)
    assert linear.accuracies(5).mean() < 0.8


def test_stages_and_paths_go_on_from_saved_weights(spark):
    shards = nets.feature_shards(table(spark, 120), 3)
    net = Net((4,), "relu", "sgd", step=0.1)
    whole = nets.fit(shards, net, 4)
    path = nets.fit_path(shards, nets.penalty_path(net, l2=[0.5, 0.0]), 4)
    assert [f.net.l2 for f in path] == [0.0, 0.5]
    # The second begins where the first ended.
    assert np.allclose(path[1].history[0, :, 0], path[0].history[-1, :, 0])
    assert np.allclose(whole.history, nets.fit_all(shards, [net], 4)[0].history)
    parts = nets.fit(shards, net, 4, split=3)
    assert np.allclose(whole.history, parts.history) and np.allclose(whole.state.weights, parts.state.weights)
    rows = nets.cv_table(spark, path, [2, 4], ["l2"]).collect()
    assert [r.setting for r in rows] == ["epochs=2, l2=0.0", "epochs=4, l2=0.0", "epochs=2, l2=0.5", "epochs=4, l2=0.5"]


def test_words(spark):
    # The label says whether the first word is word 1; word 3 has no vector.
    data = spark.range(300).select("id", F.array((F.col("id") % 2 + 1), F.lit(3), F.col("id") % 5 + 1).cast("array<bigint>").alias("seq"))
    data = data.withColumns({"label": (F.col("id") % 2 == 0).cast("double"), "fold": F.when(F.col("id") % 10 == 0, -1).otherwise((F.col("id") % 3).cast("int"))})
    data = data.withColumn("held", F.col("fold") < 0)
    data = data.unionByName(spark.createDataFrame([(1000, [], 0.0, 0, False), (1001, [1], None, 0, False)], "id long, seq array<bigint>, label double, fold int, held boolean"))
    matrix = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (4, [0.5, 0.5]), (5, [-1.0, 0.2]), (77, [9.0, 9.0])], "idx long, vector array<float>")
    shards = nets.word_shards(data, matrix, 2, 3)
    assert shards.inputs == 6 and shards.frame.selectExpr("size(words) n").first().n == 4
    for hidden in ((), (5,)):
        fitted = nets.fit(shards, Net(hidden, "tanh", "adam", step=0.05), 20)
        assert (fitted.accuracies(20) > 0.98).all()
        assert nets.predictions(shards, fitted).count() == 30 and nets.predictions(shards, fitted, held_out=False).count() == 301


def test_no_rows(spark):
    shards = nets.feature_shards(table(spark).limit(0), 3)
    fitted = nets.fit(shards, Net((2,)), 2)
    assert fitted.history.shape == (3, 4, 6) and not fitted.history.any() and nets.predictions(shards, fitted).count() == 0
    assert math.isclose(fitted.accuracies(2).sum(), 0)


def test_driver_holds_only_the_parts_that_train_together(spark, monkeypatch):
    import threading

    shards = nets.feature_shards(table(spark, 120), 3)
    net, one_round = Net((4,), "relu", "adam"), nets._one_round
    whole = nets.fit(shards, net, 4)
    at_once, most, lock = [0], [0], threading.Lock()

    def counted(shards, net, state, epochs):
        with lock:
            at_once[0] += len(state.models)
            most[0] = max(most[0], at_once[0])
        try:
            return one_round(shards, net, state, epochs)
        finally:
            with lock:
                at_once[0] -= len(state.models)

    monkeypatch.setattr(nets, "_one_round", counted)
    parts = nets.fit(shards, net, 4, split=4, together=1)
    assert most[0] == 1
    assert np.allclose(whole.history, parts.history) and np.allclose(whole.state.weights, parts.state.weights)


@pytest.mark.parametrize("net", [Net((4, 3), "relu", "adam", batch=7), Net((4,), "tanh", "sgd", batch=7, l1=0.01, l2=0.1), Net((3,), "relu", "rmsprop", batch=50)])
def test_workers_side_by_side_learn_as_each_alone(net):
    """Workers of several sizes, one of which has fewer rows than a mini-batch and one none to learn from."""
    rng = np.random.default_rng(3)
    group = []
    for worker, n in enumerate([40, 3, 63, 35, 9]):
        fold = np.full(n, -1) if worker == 4 else rng.integers(0, 2, n)
        rows = dense_rows(rng.standard_normal((n, 5)), rng.integers(0, 2, n).astype(float), fold)
        if worker == 4:
            rows.held = np.ones(n, bool)
            rows.learning = np.flatnonzero(rows.fold >= 0)
        group.append((worker, rows))
    state = nets.State.of(net, nets.start_weights(net, 5, 3, float))
    state.steps = 11.0
    for (worker, rows), (seen, own) in zip(group, nets.run_side_by_side(net, 5, state, group, 4)):
        alone = state.copy()
        assert np.array_equal(seen, nets.run_epochs(net, 5, alone, rows, range(4, 5), worker))
        assert own.steps == alone.steps and np.allclose(own.weights, alone.weights, rtol=1e-12, atol=1e-14)


def test_workers_share_files_and_come_back_as_they_were_written(spark):
    """Opening a file for every worker took longer than its epoch."""
    cores = spark.sparkContext.defaultParallelism
    rows = 2000 * (2 * cores + 3)
    df = spark.range(rows).select("id", (F.col("id") % 2).cast("double").alias("label"), array_to_vector(F.array(F.col("id") * 1.0, F.col("id") * 0.5)).alias("features"))
    df = df.withColumns({"fold": (F.col("id") % 3).cast("int"), "held": F.col("id") % 5 == 0})
    shards = nets.feature_shards(df, 3)
    assert shards.workers == 2 * cores + 3 and len(shards.frame.inputFiles()) <= 2 * cores
    found = {}
    for batch in shards.frame.toArrow().to_batches():
        for _, part in nets._shard_rows([batch], 0):
            found |= zip(part.ids.to_pylist(), zip(part.y, part.fold, part.held, part.x.tolist()))
    assert found == {k: (k % 2, k % 3, k % 5 == 0, [k * 1.0, k * 0.5]) for k in range(rows)}
