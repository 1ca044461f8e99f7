"""Running totals and row numbers over a whole table, without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinscope.sources.scratch import ensure_checkpoint_dir


def with_running_totals(df: DataFrame, order: list[Column], totals: dict[str, Column]) -> DataFrame:
    """Add inclusive running sums of ``totals`` along ``order`` (a unique key).

    The rows are range-sorted once and checkpointed, so partition numbers are the
    same for every later read, even after an executor is lost. Each range is then
    summed on its own and shifted by the total of the ranges before it. The shift
    table has one row per partition.
    """
    ensure_checkpoint_dir(df.sparkSession)
    values = {f"_v_{n}": c for n, c in totals.items()}
    ranged = df.withColumns(values).orderBy(*order).checkpoint().withColumn("_part", F.spark_partition_id())
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy("_part")
        .agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in totals])
        .select("_part", *[F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_s_{n}") for n in totals])
    )
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumns({n: F.sum(f"_v_{n}").over(within) for n in totals})
        .join(F.broadcast(shifts), "_part")
        .withColumns({n: F.col(n) + F.col(f"_s_{n}") for n in totals})
        .select(*df.columns, *totals)
    )


def with_row_number(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number all rows from 1 along a unique order."""
    return with_running_totals(df, order, {name: F.lit(1).cast("long")})
