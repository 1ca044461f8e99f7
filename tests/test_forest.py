import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.wrapper import JavaModel
from pyspark.sql import functions as F

from twinscope.operators.features import FEATURES
from twinscope.plans import forest, models, scoring


def rows(spark, n=600):
    df = spark.range(n).select("id", *[(F.pmod(F.hash(F.col("id") * 7 + k), F.lit(100)) / 100.0).alias(f"x{k}") for k in range(4)])
    wrong = F.pmod(F.hash("id"), F.lit(10)) == 0
    df = df.withColumn("label", ((F.col("x0") + F.col("x1") > 1) != wrong).cast("double"))
    return models.assemble(df, [f"x{k}" for k in range(4)]).select("id", "label", "features")


def shares(df):
    return {r.id: (r.prediction, tuple(r.p)) for r in df.select("id", "prediction", vector_to_array("probability").alias("p")).collect()}


@pytest.mark.parametrize("dense", [0, 10**9])
def test_cuts_are_the_best_of_all(monkeypatch, dense):
    monkeypatch.setattr(forest, "DENSE", dense)
    rng = np.random.default_rng(5)
    n, node = 200, np.sort(rng.integers(0, 3, 200))
    x, y, w = rng.integers(0, 9, n), rng.integers(0, 3, n), rng.integers(1, 4, n)
    totals = np.bincount(node * 3 + y, w, 9).reshape(3, 3)
    score, cut = forest._best_cuts(x, node, y, w, totals)

    def purity(of):
        c = np.bincount(y[of], w[of], 3)
        return (c * c).sum() / c.sum() if c.sum() else -np.inf

    for k in range(3):
        every = [purity((node == k) & (x <= b)) + purity((node == k) & (x > b)) for b in range(8)]
        assert np.isclose(score[k], max(every)) and cut[k] == int(np.argmax(every))


def test_a_tree_knows_the_rows_it_took():
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 32, (500, 6)).astype(np.uint8), rng.integers(0, 2, 500).astype(np.uint8)
    w = rng.poisson(1, 500).astype(np.uint8)
    tree = forest.grow(x, y, w, 2, 6, 30, rng)
    says = tree["share"][forest.leaves(tree, x)].argmax(axis=1)
    assert (says == y)[w > 0].all() and (says == y)[w == 0].mean() < 0.8
    # No two leaves of one parent say the same.
    inner = np.flatnonzero(tree["left"] >= 0)
    both = [tree["left"][tree["left"][inner] + k] for k in (0, 1)]
    ends = (both[0] < 0) & (both[1] < 0)
    pair = [tree["share"][-1 - b[ends]].argmax(axis=1) for b in both]
    assert ends.any() and (pair[0] != pair[1]).all()
    shallow = forest.grow(x, y, w, 2, 6, 1, rng)
    assert len(shallow["left"]) <= 3


def test_large_tables_are_split_before_tasks_grow_the_rest(spark):
    data = rows(spark)
    whole, parted = forest.fit(data, 20), forest.fit(data, 20, unit_rows=60)
    assert not whole.plan.tops and len(parted.plan.tops) == 20
    assert parted.table(spark).groupBy("tree").count().agg(F.min("count")).first()[0] > 1
    test = rows(spark, 900).where("id >= 600")
    for model in (whole, parted):
        out = shares(model.transform(test))
        assert len(out) == 300 and all(abs(sum(p) - 1) < 1e-9 and p[int(a)] == max(p) for a, p in out.values())
        hit = model.transform(test).where("label = prediction").count()
        assert hit > 0.75 * 300


def test_units_of_a_split_tree_hold_every_row_it_took_once(spark):
    data = forest.shards(rows(spark), 99)
    tops = forest.upper_trees(data, 3, 2, 30, 60)
    frame, units = forest._units(data, tops, 60)
    held = {}
    for r in frame.collect():
        (tree, node), = units[r.unit]
        held[tree] = held.get(tree, 0) + sum(r.w)
    for tree, top in enumerate(tops):
        closed = sum(sum(c) for c in top.closed.values())
        taken = sum(int(forest._taken(99, r.part, r.number, r.n, tree).sum()) for r in data.frame.collect())
        assert held[tree] + closed == taken


def test_scorer_keeps_its_trees_out_of_the_driver(spark, tmp_path):
    """The driver has the limits of bins only; saving and loading it gives the same shares, also row by row."""
    values = [(F.pmod(F.hash(F.col("id") + k), F.lit(50)) / 50.0).alias(c) for k, c in enumerate(FEATURES)]
    table = spark.range(3000).select("id", F.pmod(F.hash("id"), F.lit(2)).alias("y"), *values)
    model = scoring.fit_scorer(table, "y", trees=30)
    grown = model.stages[1]
    assert not isinstance(grown, JavaModel)
    assert grown.table(spark).select(F.sum(F.length("left") / 4)).first()[0] > 10_000 and len(grown.plan.to_json()) < 30_000
    models.save_model(model, str(tmp_path / "model"))
    loaded = models.load_model(str(tmp_path / "model"))
    assert isinstance(loaded, PipelineModel) and loaded.stages[1].uid == grown.uid
    before = shares(model.transform(table))
    assert shares(loaded.transform(table)) == before
    by_row = forest._named(loaded.stages[0].transform(table).withColumn("_votes", loaded.stages[1]._row_votes(spark)("features")))
    after = shares(by_row)
    assert all(after[k][0] == a and np.allclose(after[k][1], p) for k, (a, p) in before.items())


def test_labels_and_features_must_be_numbers(spark):
    data = rows(spark, 20)
    with pytest.raises(ValueError):
        forest.fit(data.withColumn("label", F.lit(None).cast("double")), 2)
    with pytest.raises(ValueError):
        forest.fit(data.where("id < 0"), 2)
