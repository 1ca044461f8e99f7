"""Reproducible samples, splits and folds.

Every choice is a function of a row's id and a seed, never of partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinscope.operators.ranking import with_row_number


def order_key(key: str, seed: int) -> Column:
    """Hex digest used as a pseudo-random order."""
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))


def hash_percent(key: str, seed: int) -> Column:
    """Whole number from 0 to 99, uniform over ids."""
    return F.pmod(F.conv(F.substring(order_key(key, seed), 1, 8), 16, 10).cast("long"), F.lit(100))


def sample_per_class(df: DataFrame, label: str, key: str, sizes: dict[int, int], seed: int) -> DataFrame:
    """Exactly ``sizes[c]`` rows of class c, lowest digests first (all, if fewer).

    No sort of the table: digests are counted by their first four hex digits, the
    running count per class finds the one bucket where the sample ends, and only
    that bucket (about 1/65536 of the class) is ordered.
    """
    size = F.create_map(*[F.lit(x) for c, n in sizes.items() for x in (int(c), int(n))])
    keyed = df.where(F.col(label).isin(list(sizes))).withColumn("_key", order_key(key, seed))
    keyed = keyed.withColumn("_bucket", F.substring("_key", 1, 4))
    upto = Window.partitionBy(label).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        keyed.groupBy(label, "_bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("total", F.sum("n").over(upto))
        .withColumn("want", size[F.col(label).cast("int")])
        .where((F.col("total") >= F.col("want")) & (F.col("total") - F.col("n") < F.col("want")))
        .select(label, F.col("_bucket").alias("_cut"), (F.col("want") - F.col("total") + F.col("n")).alias("_need"))
    )
    # one row per requested class
    marked = keyed.join(F.broadcast(cut), label, "left")
    whole = marked.where(F.col("_cut").isNull() | (F.col("_bucket") < F.col("_cut")))
    edge = (
        marked.where(F.col("_bucket") == F.col("_cut"))
        .withColumn("_rn", F.row_number().over(Window.partitionBy(label).orderBy("_key", key)))
        .where(F.col("_rn") <= F.col("_need"))
    )
    return whole.select(*df.columns).unionByName(edge.select(*df.columns))


def fraction_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Bernoulli sample; depends on partitioning."""
    return df.sample(fraction=fraction, seed=seed)


def hash_fraction_sample(df: DataFrame, key: str, percent: int, seed: int) -> DataFrame:
    """The same rows at every run: digest below the percentage."""
    return df.where(hash_percent(key, seed) < percent)


def with_split(df: DataFrame, key: str, seed: int, train_percent: int = 75) -> DataFrame:
    """Mark each row ``train`` or ``test`` by its digest."""
    side = F.when(hash_percent(key, seed) < train_percent, "train").otherwise("test")
    return df.withColumn("split", side)


def with_folds(df: DataFrame, label: str, key: str, k: int, seed: int) -> DataFrame:
    """Stratified fold numbers 0..k-1: class sizes per fold differ by at most one.

    Rows are numbered by (class, digest) over the whole table, and a class is a
    contiguous run of numbers, so the remainder by k spreads it evenly.
    """
    keyed = df.withColumn("_key", order_key(key, seed))
    numbered = with_row_number(keyed, [F.col(label).asc(), F.col("_key").asc(), F.col(key).asc()], "_rn")
    return numbered.withColumn("fold", F.pmod(F.col("_rn") - 1, F.lit(k)).cast("int")).select(*df.columns, "fold")
