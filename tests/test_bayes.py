"""Naive Bayes from saved counts: any split of the rows, replays, merged stores, and Spark's own."""

import math
import random

import pytest
from pyspark.ml.linalg import Vectors

from twinscope.plans import bayes, models

NAN = float("nan")


def rows(n=200, seed=1):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        y = float(rng.random() < 0.4)
        x = [float(rng.random() < 0.2 + 0.5 * y), rng.gauss(y, 1), -1.0, rng.choice([NAN, 0.0, 2.0])]
        out.append((k, y, Vectors.dense(x)))
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(), ["id", "label", "features"])


def scores(df):
    return {r.id: (round(r.log_joint_0, 9), round(r.log_joint_1, 9), r.prediction) for r in df.collect()}


def test_any_split_replays_and_merges_give_the_same(spark, table, tmp_path):
    whole = bayes.score(table, bayes.counts(table))
    want = scores(whole)
    one = bayes.CountStore(spark, str(tmp_path / "one"))
    for k in (2, 0, 0, 2):
        one.add(table.where(f"id % 3 = {k}"), f"b{k}")
    other = bayes.CountStore(spark, str(tmp_path / "other"))
    other.add(table.where("id % 3 = 1"), "b1")
    other.add(table.where("id % 3 = 2"), "b2")
    one.take_in(other)
    one.take_in(other)
    assert scores(one.score(table)) == want
    assert {tuple(r) for r in one.table().collect()} == {tuple(r) for r in bayes.counts(table).select("label", "feature", "n").collect()}


def test_a_batch_replaces_itself(spark, table, tmp_path):
    store = bayes.CountStore(spark, str(tmp_path / "s"))
    store.add(table.limit(7), "b")
    store.add(table, "b")
    assert scores(store.score(table)) == scores(bayes.score(table, bayes.counts(table)))


def test_against_spark_and_by_hand(spark, table):
    got = scores(bayes.score(table, bayes.counts(table)))
    data = rows()
    n = {y: sum(r[1] == y for r in data) for y in (0.0, 1.0)}
    held = {y: [sum(r[1] == y and r[2][j] > 0 for r in data) for j in range(4)] for y in n}
    for i, _, x in data:
        for y in (0, 1):
            want = math.log(n[y] + 1) - math.log(len(data) + 2)
            want += sum(math.log((held[y][j] if x[j] > 0 else n[y] - held[y][j]) + 1) - math.log(n[y] + 2) for j in range(4))
            assert got[i][y] == pytest.approx(want, abs=1e-8)
    clean = spark.createDataFrame([(i, y, Vectors.dense([0.0 if v != v else v for v in x])) for i, y, x in data], ["id", "label", "features"])
    model = models.bernoulli_bayes().fit(clean)
    raw = {r.id: r.rawPrediction.toArray() for r in model.transform(clean).collect()}
    assert all(got[i][y] == pytest.approx(raw[i][y], abs=1e-8) for i in raw for y in (0, 1))


def test_no_rows(spark, table, tmp_path):
    empty = bayes.CountStore(spark, str(tmp_path / "e"))
    empty.add(table.limit(0), "b")
    with pytest.raises(ValueError, match="no rows"):
        empty.score(table)
    one = table.where("id = 0").union(table.where("id = 1").selectExpr("id", "double(null)", "features"))
    assert {(r.feature, r.n) for r in bayes.counts(one).collect() if r.feature == bayes.ROWS} == {(bayes.ROWS, 1)}
