"""Two-pass external shuffle: scatter by a seeded hash, then Fisher-Yates in each bucket."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinscope.operators.ranking import with_running_totals
from twinscope.sources.scratch import scratch_path

#: Text bytes that a bucket holds on average; a task keeps one bucket in memory.
BUCKET_BYTES = 32 << 20


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniform permutation of 0 to n - 1."""
    order = list(range(n))
    swaps = rng.integers(0, np.arange(1, n + 1)).tolist()
    for i in range(n - 1, 0, -1):
        j = swaps[i]
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def _shuffle_bucket(seed: int, columns: list[str]) -> Callable[[pa.Table], pa.Table]:
    def shuffled(rows: pa.Table) -> pa.Table:
        bucket = rows.column("_bucket")[0].as_py()
        rows = rows.sort_by([("_key", "ascending"), ("_key2", "ascending")])
        order = fisher_yates(rows.num_rows, np.random.default_rng([seed, bucket]))
        out = rows.select([*columns, "_bucket"]).take(pa.array(order))
        return out.append_column("_place", pa.array(np.arange(rows.num_rows, dtype=np.int64)))

    return shuffled


def external_shuffle(
    docs: DataFrame, n_shards: int, seed: int = 0, text: str = "text", ident: str = "doc_id", bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """All rows of ``docs`` in uniform random order, cut into ``n_shards`` shards.

    Adds ``shard`` (0 to n_shards - 1; row counts differ by one at most) and ``slot`` (gapless
    from 0 in each shard). Pass 1 scatters rows by a seeded hash of id, text and input
    partition, so copies of one row spread over buckets; the number of buckets follows the
    total size, so each fits in memory. Pass 2 shuffles each bucket by Fisher-Yates and writes
    it. Buckets follow each other in the final order; a running total of their counts gives
    each row's place. The order depends on the seed and on the layout of the input files.

    Null ids and texts are values like others (a null text has no bytes); equal rows are each
    placed; an empty table gives no rows. Columns ``shard`` and ``slot`` of the input are
    replaced; names that begin with an underscore are reserved.
    """
    docs = docs.drop("shard", "slot")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    rows, total = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    n_buckets = max(1, -(-total // bucket_bytes))
    scattered = docs.withColumns(
        {"_key": F.xxhash64(F.lit(seed), ident, text), "_key2": F.xxhash64(F.lit(seed + 1), text, ident)}
    ).withColumn("_bucket", F.pmod(F.xxhash64("_key", F.spark_partition_id()), F.lit(n_buckets)))
    schema = docs.withColumns({"_bucket": F.lit(0).cast("long"), "_place": F.lit(0).cast("long")}).schema
    path = scratch_path(docs.sparkSession, "shuffled")
    scattered.groupBy("_bucket").applyInArrow(_shuffle_bucket(seed, docs.columns), schema).write.parquet(path)
    written = docs.sparkSession.read.schema(schema).parquet(path)
    counts = written.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    ends = with_running_totals(counts, [F.col("_bucket")], {"_end": F.col("_n")})
    place = F.col("_end") - F.col("_n") + F.col("_place")
    shard = F.expr(f"(_rank * {n_shards}L) div {max(rows, 1)}L")
    begins = F.expr(f"(_shard * {rows}L + {n_shards - 1}L) div {n_shards}L")
    return (
        written.join(ends, "_bucket")
        .withColumn("_rank", place)
        .withColumn("_shard", shard)
        .select(*docs.columns, F.col("_shard").cast("int").alias("shard"), (F.col("_rank") - begins).alias("slot"))
    )


def write_shards(shuffled: DataFrame, path: str) -> None:
    """Write each shard as a folder of files whose names follow the order of the slots."""
    shuffled.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
