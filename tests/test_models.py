from pyspark.sql import functions as F

from twinscope.operators.features import FEATURES, pair_features, clean_pairs
from twinscope.plans import catalog, models, scoring
from twinscope.streaming import scoring as stream

SF = "/root/testdata/sf0.001"


def numeric(spark, n=400):
    df = spark.range(n).select("id", (F.hash("id") % 100 / 100.0).alias("a"), (F.hash(F.col("id") + 7) % 100 / 100.0).alias("b"))
    return df.withColumn("y", (F.col("a") + 0.2 * F.col("b") > 0).cast("int"))


def accuracy(df):
    return df.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]


def test_classifiers_beat_the_majority(spark):
    train, test = models.training_tables(numeric(spark), ["a", "b"], "y", "id")
    n = train.count()
    majority = test.agg(F.greatest(F.avg("label"), 1 - F.avg("label"))).first()[0]
    fitted = {
        "logistic": models.logistic(n).fit(train),
        "svm": models.fit_linear_svm(train, max_iter=20),
        "tree": models.decision_tree().fit(train),
        "forest": models.random_forest(trees=10).fit(train),
        "bayes": models.bernoulli_bayes().fit(train),
        "net": models.perceptron(2, (4,), max_iter=40).fit(train),
    }
    for name, model in fitted.items():
        out = models.scored(model, test)
        assert accuracy(out) > majority, name
        assert out.where("probability is null").count() == 0
    history = models.best_of_history(train, fitted["net"]).first()
    assert 0 <= history["best_iteration"] <= history["iterations"]


def test_search_returns_every_setting(spark):
    train, _ = models.training_tables(numeric(spark, 200), ["a", "b"], "y", "id")
    n = train.count()
    estimator = models.logistic(n, max_iter=10)
    grid = models.penalised_grid(estimator, n, [0.5, 2.0], [True, False])
    fitted = models.cross_validated(estimator, grid, models.folded(train, 3), 3)
    rows = models.cv_summary(train, fitted, grid).collect()
    assert len(rows) == 4 and all(0.5 < r["mean_accuracy"] <= 1 for r in rows)


def test_svm_probabilities_come_from_held_out_margins(spark):
    """Labels without any link to the columns: margins of the rows an SVM learned from claim one."""
    noise = [F.sin(F.hash(F.col("id") * 31 + k).cast("double")).alias(f"x{k}") for k in range(30)]
    df = spark.range(400).select("id", F.pmod(F.hash(F.col("id") + 5), F.lit(2)).cast("double").alias("label"), *noise)
    rows = models.assemble(df, [f"x{k}" for k in range(30)]).select("id", "label", "features")
    train, test = rows.where("id < 120").checkpoint(), rows.where("id >= 120").checkpoint()

    def loss(model):
        p = F.least(F.greatest("probability", F.lit(1e-9)), F.lit(1 - 1e-9))
        return models.scored(model, test).agg(F.avg(F.when(F.col("label") == 1, -F.log(p)).otherwise(-F.log(1 - p)))).first()[0]

    svm = models.LinearSVC(maxIter=100, tol=models.TOLERANCE, rawPredictionCol="margin", predictionCol="svm_side").fit(train)
    own = models.LogisticRegression(featuresCol="margin", maxIter=100, tol=models.TOLERANCE).fit(svm.transform(train))
    assert loss(models.fit_linear_svm(train)) < loss(models.PipelineModel(stages=[svm, own]))


def test_net_queries_search_what_they_say(spark, monkeypatch):
    train, test = models.training_tables(numeric(spark, 120), ["a", "b"], "y", "id")
    monkeypatch.setattr(catalog, "turn_training", lambda spark, d: (train, test))
    settings = {name: [r.setting for r in catalog.QUERIES[name](spark, SF).collect()] for name in ("sweep_mlp_iters", "sweep_mlp_solver", "grid_mlp", "path_mlp_l1", "cv_mlp")}
    assert settings["sweep_mlp_iters"] == [f"epochs={e}, batch={b}" for b in (10, 20) for e in (100, 200)]
    assert len(set(settings["sweep_mlp_solver"])) == 6 and len(set(settings["grid_mlp"])) == 6
    assert len(settings["path_mlp_l1"]) == 2 and len(settings["cv_mlp"]) == 3
    history = {r.part: r for r in catalog.training_history(spark, SF).collect()}
    assert set(history) == {"train", "validation"} and all(0 < r.best_accuracy <= 1 and r.lowest_loss > 0 for r in history.values())


def test_batch_equals_stream_and_saved_model_agrees(spark, tmp_path):
    rows = [
        (1, "how do i learn spark quickly", "how can i learn spark quickly", 1),
        (2, "what is a good book", "where is the nearest station", 0),
        (3, "best way to cook rice", "what is the best way to cook rice", 1),
        (4, "is it raining", "who won the cup in 1998", 0),
    ] * 6
    table = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], "id long, question1 string, question2 string, y int")
    features = pair_features(clean_pairs(table, "question1", "question2", "id"))
    model = scoring.fit_scorer(features, "y", trees=5)
    models.save_model(model, str(tmp_path / "model"))
    loaded = models.load_model(str(tmp_path / "model"))

    requests = spark.createDataFrame(
        [(1, "how do i learn", "how can i learn"), (2, None, "x"), (3, "", "")], stream.REQUEST_SCHEMA
    )
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    requests.write.parquet(source)
    batch = scoring.score_pairs(requests, model).collect()
    query = stream.run_available(
        stream.read_requests(spark, source), lambda df: scoring.score_pairs(df, loaded), sink, str(tmp_path / "state")
    )
    query.awaitTermination()
    assert sorted(map(tuple, batch)) == sorted(map(tuple, spark.read.parquet(sink).collect()))
    assert {r["id"] for r in batch} == {1, 2, 3}
    lemmas = spark.createDataFrame([("cats", "cat")], "word string, lemma string")
    again = str(tmp_path / "batches")
    stream.run_batches(
        stream.read_requests(spark, source), lambda df: scoring.score_pairs(df, loaded, lemmas=lemmas), again, str(tmp_path / "state2")
    ).awaitTermination()
    assert spark.read.parquet(again).count() == 3


def test_forest_keeps_nodes_of_rows_and_grows_the_same_trees(spark):
    train, _ = models.training_tables(numeric(spark), ["a", "b"], "y", "id")
    forest = models.random_forest(trees=5)
    assert forest.getCacheNodeIds()
    plain = forest.copy({forest.cacheNodeIds: False})
    assert forest.fit(train).toDebugString.split("\n")[1:] == plain.fit(train).toDebugString.split("\n")[1:]


def test_penalised_search_fits_all_models_side_by_side(spark):
    """Coefficients are those of Spark's own regressions run to the end, for both penalties; a
    search takes a job or two per pass, not per model and pass."""
    import numpy as np

    from twinscope.plans import logistic

    rows = numeric(spark, 300).withColumn("y", F.when(F.col("id") % 7 == 0, 1 - F.col("y")).otherwise(F.col("y")))
    train, _ = models.training_tables(rows, ["a", "b"], "y", "id")
    data = models.folded(train, 3)
    settings = [(reg, ratio) for ratio in (0.0, 1.0) for reg in (0.003, 0.03)]
    blocks = logistic.packed(data)
    own = np.repeat(np.arange(3.0), len(settings))
    reg, ratio = (np.tile([s[k] for s in settings], 3) for k in (0, 1))
    betas = logistic.fit(blocks, own, reg, ratio, 100, 1e-5)
    hits = []
    for beta, fold, r, e in zip(betas, own, reg, ratio):
        exact = models.LogisticRegression(maxIter=500, tol=1e-12, regParam=float(r), elasticNetParam=float(e), standardization=False)
        model = exact.fit(data.where(F.col("fold") != fold))
        assert np.abs(beta - [model.intercept, *model.coefficients]).max() < 1e-3
        hits.append(accuracy(models.scored(model, data.where(F.col("fold") == fold))))
    found = logistic.fold_accuracies(data, settings, 3, 100, 1e-5)
    assert np.abs(found.ravel() - hits).max() < 1e-9
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("search", "")
    models.fit_penalised(train, l1=True, folds=3)
    count = len(jobs.getJobIdsForGroup("search"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert count < 400
