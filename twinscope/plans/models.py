"""Classifiers on feature columns, fitted and tuned by Spark ML.

A training table is ``(id, label, features, fold)``; fits return Spark ML models,
``scored`` turns any of them into ``(id, label, prediction, probability)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Binarizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinscope.operators import prepare, sampling
from twinscope.plans import logistic as side_by_side
from twinscope.sources.scratch import ensure_checkpoint_dir

# The inverse penalties searched by the penalised regressions.
C_GRID = [10.0**e for e in range(-2, 7)]
# Fixed value: where the linear fits stop.
TOLERANCE = 1e-4


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="keep").transform(df)


def training_tables(
    df: DataFrame, columns: Sequence[str], label: str, key: str, seed: int = 99, standardise: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Split by digest, scale with the training statistics, repair, assemble.

    The numeric table is checkpointed once: an iterative fit then never goes back to
    the text features, whatever executors are lost. Its layout is by id, so AQE packs
    it by size: an iteration over a small table is a few tasks, over a large one many.
    """
    ensure_checkpoint_dir(df.sparkSession)
    numeric = df.select(
        F.col(key).alias("id"), F.col(label).cast("double").alias("label"), *[F.col(c).cast("double") for c in columns]
    )
    numeric = sampling.with_split(numeric.repartition("id"), "id", seed).checkpoint()
    train = numeric.where(F.col("split") == "train")
    if standardise:
        numeric = prepare.Standardizer.fit(train, list(columns)).transform(numeric)
    ready = assemble(prepare.repair(numeric, list(columns)), columns).select("id", "label", "features", "split")
    return ready.where(F.col("split") == "train"), ready.where(F.col("split") == "test")


def folded(train: DataFrame, k: int, seed: int = 99) -> DataFrame:
    """Fold numbers are fixed once; every fit of a search reads the same table."""
    return sampling.with_folds(train, "label", "id", k, seed).repartition("id").checkpoint()


# --- estimators -----------------------------------------------------------------


def logistic(n_rows: int, c: float = 1.0, l1: bool = False, max_iter: int = 200) -> LogisticRegression:
    """Penalty ``1 / (C n)``: Spark averages the loss where others sum it."""
    return LogisticRegression(
        maxIter=max_iter, tol=TOLERANCE, regParam=1.0 / (c * n_rows), elasticNetParam=float(l1), standardization=False
    )


def bernoulli_bayes() -> Pipeline:
    """Features above zero count as present. One aggregation fits it, so partitions
    may come in any order or one after the other."""
    return Pipeline(
        stages=[
            Binarizer(threshold=0.0, inputCol="features", outputCol="present"),
            NaiveBayes(featuresCol="present", modelType="bernoulli", smoothing=1.0),
        ]
    )


def decision_tree(seed: int = 99) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(maxDepth=30, seed=seed)


def random_forest(trees: int = 1000, seed: int = 99, max_depth: int = 30) -> RandomForestClassifier:
    """Each row keeps its node of every tree: else all trees grown so far, with the statistics of
    their nodes, would go to every task of every level. The trees are the same."""
    return RandomForestClassifier(
        numTrees=trees, maxDepth=max_depth, featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=True
    )


def perceptron(inputs: int, hidden: Sequence[int], max_iter: int = 100, seed: int = 99) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(layers=[inputs, *hidden, 2], maxIter=max_iter, seed=seed)


# Hidden layers of the three feed-forward nets; the second is the chosen one.
NETS = {"mlp_1": (18, 18, 18), "mlp_2": (18, 9), "mlp_3": (18, 9, 6)}


def fit_linear_svm(train: DataFrame, max_iter: int = 100, folds: int = 5) -> PipelineModel:
    """A linear SVM, then a logistic regression on its margin for probabilities.

    A row's margin is larger under a model that learned from it, so the regression learns from
    margins that each row gets by the SVM of the other folds. These are fitted side by side and
    their margins written before the regression goes over them.
    """
    svm = LinearSVC(maxIter=max_iter, tol=TOLERANCE, rawPredictionCol="margin", predictionCol="svm_side")
    data = folded(train, folds)

    def held_out(k: int) -> DataFrame:
        return svm.fit(data.where(F.col("fold") != k)).transform(data.where(F.col("fold") == k)).select("id", "label", "margin")

    with ThreadPoolExecutor(folds + 1) as pool:
        whole = pool.submit(svm.fit, train)
        margins = reduce(DataFrame.unionByName, pool.map(held_out, range(folds)))
        margins = margins.checkpoint()
        calibrate = LogisticRegression(featuresCol="margin", maxIter=100, tol=TOLERANCE)
        return PipelineModel(stages=[whole.result(), calibrate.fit(margins)])


# --- fitting, tuning, scoring ----------------------------------------------------


def scored(model: Transformer, df: DataFrame) -> DataFrame:
    out = model.transform(df)
    return out.select(
        "id",
        F.col("label").cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("probability")
        if "probability" in out.columns
        else F.lit(None).cast("double").alias("probability"),
    )


def accuracy_metric() -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(metricName="accuracy")


def cross_validated(
    estimator: Estimator, grid: list[dict], train: DataFrame, folds: int, parallelism: int = 8
) -> CrossValidatorModel:
    """Search a grid on stratified folds given by the ``fold`` column."""
    return CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=accuracy_metric(),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    ).fit(train)


def cv_summary(df: DataFrame, model: CrossValidatorModel, grid: list[dict]) -> DataFrame:
    """One row per setting: mean and deviation of the accuracy over the folds."""
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in sorted(setting.items(), key=lambda x: x[0].name)), float(m), float(s))
        for setting, m, s in zip(grid, model.avgMetrics, model.stdMetrics)
    ]
    return df.sparkSession.createDataFrame(rows, "setting string, mean_accuracy double, std_accuracy double")


def penalised_grid(estimator: LogisticRegression, n_rows: int, cs: Sequence[float], l1: Sequence[bool]) -> list[dict]:
    return (
        ParamGridBuilder()
        .addGrid(estimator.elasticNetParam, [float(x) for x in l1])
        .addGrid(estimator.regParam, [1.0 / (c * n_rows) for c in cs])
        .build()
    )


def searched(estimator: LogisticRegression, grid: list[dict], train: DataFrame, folds: int) -> CrossValidatorModel:
    """``cross_validated`` for penalties of a logistic regression: the models of all folds and
    settings are fitted side by side, the best setting then on all rows by Spark ML."""
    settings = [(s[estimator.regParam], s[estimator.elasticNetParam]) for s in grid]
    found = side_by_side.fold_accuracies(train, settings, folds, estimator.getMaxIter(), estimator.getTol())
    mean, deviation = found.mean(axis=0), found.std(axis=0)
    best = estimator.fit(train, grid[int(mean.argmax())])
    return CrossValidatorModel(best, mean.tolist(), stdMetrics=deviation.tolist())


def fit_penalised(
    train: DataFrame, l1: bool, cs: Sequence[float] = tuple(C_GRID), folds: int = 10, max_iter: int = 100
) -> CrossValidatorModel:
    """Logistic regression with its penalty chosen by cross-validation."""
    n = train.count()
    estimator = logistic(n, max_iter=max_iter)
    return searched(estimator, penalised_grid(estimator, n, cs, [l1]), folded(train, folds), folds)


def compare_nets(train: DataFrame, inputs: int, nets: dict[str, Sequence[int]], folds: int = 5, max_iter: int = 100) -> DataFrame:
    """Cross-validated accuracy of several architectures, on the same folds."""
    data = folded(train, folds)
    tables = []
    for name, hidden in nets.items():
        estimator = perceptron(inputs, hidden, max_iter)
        grid = ParamGridBuilder().build()
        summary = cv_summary(train, cross_validated(estimator, grid, data, folds), grid)
        tables.append(summary.withColumn("setting", F.lit(name)))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def search_net(
    train: DataFrame, inputs: int, hidden: Sequence[int], settings: dict[str, list] | list[dict[str, list]], folds: int = 5
) -> DataFrame:
    """Grid search of one architecture over any of its parameters; of several grids, over all."""
    estimator = perceptron(inputs, hidden)
    grid = []
    for part in [settings] if isinstance(settings, dict) else settings:
        builder = ParamGridBuilder()
        for name, values in part.items():
            builder = builder.addGrid(estimator.getParam(name), values)
        grid += builder.build()
    return cv_summary(train, cross_validated(estimator, grid, folded(train, folds), folds), grid)


def objective_history(model) -> list[float]:
    """Loss after every iteration of a fitted linear or net model."""
    summary = model.summary() if callable(getattr(model, "summary", None)) else model.summary
    return list(summary.objectiveHistory)


def best_of_history(df: DataFrame, model) -> DataFrame:
    """Lowest loss of a training run and where it was reached."""
    losses = objective_history(model)
    rows = [(len(losses) - 1, int(min(range(len(losses)), key=losses.__getitem__)), float(min(losses)))]
    return df.sparkSession.createDataFrame(rows, "iterations int, best_iteration int, lowest_loss double")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
