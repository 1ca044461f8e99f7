"""Bernoulli naive Bayes from saved counts, batch by batch.

The model is its counts: rows and present features by class. A batch adds a folder with its own
counts, whose name is the batch's, so a batch that comes again replaces itself. Folders of two
stores can be put together. Nothing that was learned is read again to add a batch.
"""

from __future__ import annotations

import hashlib

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "label int, feature int, n long"
#: The feature number under which rows of a class are counted.
ROWS = -1


def counts(df: DataFrame) -> DataFrame:
    """``(label, feature, n)``: rows of each class that hold a feature, above zero; feature -1 counts rows.

    ``df`` has ``label`` and an ML vector ``features``. Rows without a label are left out; NaN
    counts as absent. Features that no row of a class holds have a count of zero.
    """
    known = df.where("label is not null").select(F.col("label").cast("int").alias("label"), vector_to_array("features").alias("x"))
    entry = F.array_append(
        F.transform("x", lambda v, k: F.struct(k.cast("int").alias("feature"), (~F.isnan(v) & (v > 0)).cast("long").alias("n"))),
        F.struct(F.lit(ROWS).alias("feature"), F.lit(1).cast("long").alias("n")),
    )
    return known.select("label", F.explode(entry).alias("e")).groupBy("label", "e.feature").agg(F.sum("e.n").alias("n"))


def merged(parts: DataFrame) -> DataFrame:
    """Counts of several parts added up; the order doesn't matter."""
    return parts.groupBy("label", "feature").agg(F.sum("n").alias("n"))


def log_probabilities(table: DataFrame, smoothing: float = 1.0) -> DataFrame:
    """``(label, prior, present, absent)``: for each class its log prior and the log-probabilities
    of each feature, by its place, to be present and absent."""
    rows = table.where(F.col("feature") == ROWS).select("label", F.col("n").alias("rows"))
    total = rows.agg(F.sum("rows").alias("total"), F.count(F.lit(1)).alias("classes"))
    lists = table.where(F.col("feature") != ROWS).groupBy("label").agg(F.sort_array(F.collect_list(F.struct("feature", "n"))).alias("f"))
    # One row per class on every side.
    joined = rows.join(lists, "label", "left").join(F.broadcast(total))
    held, base = F.transform(F.coalesce("f", F.array().cast("array<struct<feature:int,n:bigint>>")), lambda x: x["n"]), F.col("rows") + 2 * smoothing
    return joined.select(
        "label",
        (F.log(F.col("rows") + smoothing) - F.log(F.col("total") + smoothing * F.col("classes"))).alias("prior"),
        F.transform(held, lambda n: F.log(n + smoothing) - F.log(base)).alias("present"),
        F.transform(held, lambda n: F.log(F.col("rows") - n + smoothing) - F.log(base)).alias("absent"),
    )


def score(df: DataFrame, table: DataFrame, smoothing: float = 1.0) -> DataFrame:
    """``df`` with ``log_joint_<class>`` for every class of the counts and ``prediction`` (the
    likelier class, the lower one if equal)."""
    model = log_probabilities(table, smoothing).orderBy("label").collect()
    if not model:
        raise ValueError("no rows were counted yet")
    x = vector_to_array("features")
    out = df
    for row in model:
        terms = F.zip_with(x, F.arrays_zip(F.lit(row.present).alias("p"), F.lit(row.absent).alias("a")), lambda v, t: F.when(~F.isnan(v) & (v > 0), t["p"]).otherwise(t["a"]))
        out = out.withColumn(f"log_joint_{row.label}", F.aggregate(terms, F.lit(float(row.prior)), lambda a, t: a + t))
    joint = [F.struct(F.col(f"log_joint_{r.label}").alias("j"), F.lit(-r.label).alias("l")) for r in model]
    best = F.greatest(*joint) if len(joint) > 1 else joint[0]
    return out.withColumn("prediction", (-best["l"]).cast("int"))


class CountStore:
    """Counts of batches in a shared folder, one sub-folder per batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, batch: str) -> str:
        return f"{self.path}/batch={hashlib.sha256(batch.encode()).hexdigest()[:24]}"

    def add(self, df: DataFrame, batch: str) -> None:
        """Count a batch. If it was counted before, or a run ended half-way, its counts are replaced."""
        counts(df).coalesce(1).write.mode("overwrite").parquet(self._folder(batch))

    def take_in(self, other: CountStore) -> None:
        """Add the batches of another store; those that both have count once."""
        theirs = self.spark.read.schema(f"{SCHEMA}, batch string").parquet(other.path)
        for row in theirs.select("batch").distinct().collect():
            theirs.where(F.col("batch") == row.batch).drop("batch").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={row.batch}")

    def table(self) -> DataFrame:
        # A folder without its success mark holds a batch that was not counted to the end.
        return merged(self.spark.read.schema(f"{SCHEMA}, batch string").parquet(self.path))

    def score(self, df: DataFrame, smoothing: float = 1.0) -> DataFrame:
        return score(df, self.table(), smoothing)
