"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinscope.sources.scratch import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again, which cuts its lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Link the larger (or smaller) neighbours of each node, and itself, to the least of them."""
    near = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        near = near.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        near = near.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = near.join(least, "u")
    if large:
        found = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        found = joined.select(F.explode(F.array("u", "v")).alias("a"), F.col("m").alias("b"))
    return found.where("a <> b")


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the least node reachable) for all nodes with a link.

    ``links`` has long columns ``a`` and ``b``. Each step shuffles pre-aggregated links and is
    written out; the steps grow with the logarithm of the longest path.
    """
    links = written(links.where("a <> b").select("a", "b"), "links")
    while True:
        links = written(_star(_star(links, True), False).distinct(), "links")
        # Done when no node that others are linked to has a link itself, or two.
        ends = links.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.unionByName(links.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        counts = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not counts.where("up > 1 or up = 1 and down = 1").agg(F.count(F.lit(1))).first()[0]:
            break
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)
