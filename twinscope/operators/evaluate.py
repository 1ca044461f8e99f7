"""Evaluation of a scored table: label, predicted label, score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinscope.operators.ranking import with_running_totals


def _ratio(num: Column, den: Column) -> Column:
    return num / F.when(den != 0, den)


def accuracy(df: DataFrame, label: str, predicted: str) -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(predicted)).cast("double")).alias("accuracy"))


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """All four cells of the 2x2 table, from one pass."""
    cell = lambda a, p: F.count_if((F.col(label) == a) & (F.col(predicted) == p))
    counts = df.agg(*[cell(a, p).alias(f"c{a}{p}") for a in (0, 1) for p in (0, 1)])
    rows = [
        F.struct(F.lit(a).alias("label"), F.lit(p).alias("predicted"), F.col(f"c{a}{p}").alias("n"))
        for a in (0, 1)
        for p in (0, 1)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _cells(df: DataFrame, label: str, predicted: str) -> DataFrame:
    y, z = F.col(label), F.col(predicted)
    return df.agg(
        F.count_if((y == 1) & (z == 1)).alias("tp"),
        F.count_if((y == 0) & (z == 0)).alias("tn"),
        F.count_if((y == 0) & (z == 1)).alias("fp"),
        F.count_if((y == 1) & (z == 0)).alias("fn"),
    )


def rates(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Sensitivity, specificity, precision, false positive rate; null when undefined."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    return _cells(df, label, predicted).select(
        _ratio(tp, tp + fn).alias("sensitivity"),
        _ratio(tn, tn + fp).alias("specificity"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(fp, fp + tn).alias("false_positive_rate"),
    )


def report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted means."""
    cells = _cells(df, label, predicted)
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))

    def one(name: str, hit: Column, extra: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            F.coalesce(_ratio(hit, hit + extra), F.lit(0.0)).alias("precision"),
            F.coalesce(_ratio(hit, hit + missed), F.lit(0.0)).alias("recall"),
            F.coalesce(_ratio(2 * hit, 2 * hit + extra + missed), F.lit(0.0)).alias("f1"),
            (hit + missed).alias("support"),
        )

    both = cells.select(one("0", tn, fn, fp).alias("zero"), one("1", tp, fp, fn).alias("one"))
    total = F.col("zero.support") + F.col("one.support")
    plain = lambda m: (F.col(f"zero.{m}") + F.col(f"one.{m}")) / 2
    weighted = lambda m: _ratio(
        F.col(f"zero.{m}") * F.col("zero.support") + F.col(f"one.{m}") * F.col("one.support"), total
    )
    average = lambda name, mean: F.struct(
        F.lit(name).alias("class"),
        *[mean(m).alias(m) for m in ("precision", "recall", "f1")],
        total.alias("support"),
    )
    return both.select(
        F.inline(F.array("zero", "one", average("macro avg", plain), average("weighted avg", weighted)))
    )


def _score_totals(df: DataFrame, label: str, score: str) -> tuple[DataFrame, int, int]:
    """Running positives and negatives per distinct score, and both totals."""
    y = F.col(label)
    per_score = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )
    running = with_running_totals(
        per_score, [F.col("score").desc()], {"tp": F.col("pos"), "fp": F.col("neg")}
    )
    # the last running totals are the class sizes; one row comes back
    last = running.agg(F.max("tp").alias("tp"), F.max("fp").alias("fp")).first()
    return running, last["tp"] or 0, last["fp"] or 0


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """``(threshold, tpr, fpr)`` for every distinct score, highest first."""
    points, n_pos, n_neg = _score_totals(df, label, score)
    return points.select(
        F.col("score").alias("threshold"),
        _ratio(F.col("tp"), F.lit(n_pos)).alias("tpr"),
        _ratio(F.col("fp"), F.lit(n_neg)).alias("fpr"),
    )


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve by trapezoids: each score adds its negatives times the
    positives above it, half of its own positives included."""
    points, n_pos, n_neg = _score_totals(df, label, score)
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    return points.agg(_ratio(area, F.lit(float(n_pos) * n_neg)).alias("auc"))
