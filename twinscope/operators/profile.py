"""Profiling of a pair table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinscope.functions import text


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First rows in key order."""
    return df.orderBy(key).limit(n)


def info(df: DataFrame) -> DataFrame:
    """Column name, type and non-null count, from one pass."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f.name).alias("non_null"),
            )
            for f in df.schema.fields
        ]
    )
    return counts.select(F.inline(rows))


def null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows where any listed column is null."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.col(c).isNull()
    return df.where(hit)


def key_lookup(df: DataFrame, key, columns: list[str]) -> DataFrame:
    """Rows that hold the key in any of the columns."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | (F.col(c) == F.lit(key))
    return df.where(hit)


def drop_null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop(subset=columns)


def identical_pairs(df: DataFrame, left: str, right: str) -> DataFrame:
    return df.where(F.col(left) == F.col(right))


def repeated_pairs(df: DataFrame, left: str, right: str) -> DataFrame:
    """Key pairs that occur more than once, with their count."""
    return df.groupBy(left, right).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def mirrored_pairs(df: DataFrame, key: str, left: str, right: str) -> DataFrame:
    """Occurrences of a pair key after its first one, over both reading directions.

    All ``left-right`` keys come first, then all ``right-left`` keys. A repeat in the
    same direction is reported too; ``mirrored`` tells whether the other direction
    exists. Occurrences are reduced to one count and one first id per key and side
    before any comparison, so a key that holds a third of the rows costs a partial
    aggregate, not a window.
    """
    sides = df.select(
        key,
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("side"), F.col(left).alias("a"), F.col(right).alias("b")),
                F.struct(F.lit(1).alias("side"), F.col(right).alias("a"), F.col(left).alias("b")),
            )
        ).alias("s"),
    ).select(key, "s.*")
    firsts = sides.groupBy("a", "b").agg(
        F.min(F.struct("side", key)).alias("first"),
        (F.max("side") > F.min("side")).alias("mirrored"),
        F.count(F.lit(1)).alias("n"),
    ).where(F.col("n") > 1)
    return (
        sides.join(firsts, ["a", "b"])
        .where(F.struct("side", key) > F.col("first"))
        .select(
            F.col(key),
            "side",
            F.concat_ws("-", "a", "b").alias("pair_key"),
            "mirrored",
        )
    )


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values per column, nulls counted as one value."""
    stacked = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in columns])
        ).alias("s")
    ).select("s.*")
    return stacked.distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))


def distinct_sketches(df: DataFrame, columns: list[str], lg: int = 14) -> DataFrame:
    """``(column_name, sketch, nulls)``: one small sketch per column, to be saved and merged.

    ``nulls`` is 1 if the column has a null. The estimate's error is about 1.04 / sqrt(2**lg).
    """
    stacked = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])).alias("s")
    ).select("s.*")
    return stacked.groupBy("column_name").agg(
        F.hll_sketch_agg("v", lg).alias("sketch"), F.max(F.col("v").isNull().cast("int")).alias("nulls")
    )


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """One sketch per column from those of any batches; a batch that came twice changes nothing."""
    return sketches.groupBy("column_name").agg(F.hll_union_agg("sketch").alias("sketch"), F.max("nulls").alias("nulls"))


def sketched_counts(sketches: DataFrame) -> DataFrame:
    """``(column_name, n_estimated)``; all nulls count as one value, as in ``distinct_counts``."""
    return sketches.select("column_name", (F.hll_sketch_estimate("sketch") + F.col("nulls")).cast("long").alias("n_estimated"))


def label_counts(df: DataFrame, label: str, key: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(key).alias("n"))


def length_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and exact median of words per text, one row per column.

    ``median`` keeps one counter per distinct length, so its state is bounded by the
    longest text and not by the number of rows.
    """
    aggs = []
    for c in columns:
        n = F.size(text.words(F.col(c)))
        n = F.when(F.col(c).isNotNull(), n)
        aggs.append(F.struct(F.lit(c).alias("column_name"), F.avg(n).alias("mean_words"), F.median(n).alias("median_words")).alias(c))
    return df.agg(*aggs).select(F.inline(F.array(*[F.col(c) for c in columns])))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Percentage of both classes, rounded half to even to two places."""
    share = F.rint(F.avg(F.col(label).cast("double")) * 100 * 100) / 100
    return df.agg(share.alias("pct_duplicate")).select(
        (F.lit(100.0) - F.col("pct_duplicate")).alias("pct_not_duplicate"), "pct_duplicate"
    )


def label_preview(df: DataFrame, label: str, value: int, key: str, n: int = 5) -> DataFrame:
    return head(df.where(F.col(label) == value), key, n)


def label_values(df: DataFrame, label: str) -> DataFrame:
    return df.select(label).distinct()


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in any of the columns."""
    return df.na.drop("any", subset=columns)


def project(df: DataFrame, columns: list[str | Column]) -> DataFrame:
    return df.select(*columns)
