"""Streaming features and scores.

Everything up to the prediction is row-local, so the stream keeps no state and
writes in append mode; a restart resumes from the query's checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("question1", T.StringType()),
        T.StructField("question2", T.StringType()),
    ]
)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(REQUEST_SCHEMA).parquet(path)


def run_available(
    requests: DataFrame, transform: Callable[[DataFrame], DataFrame], output: str, checkpoint: str
) -> StreamingQuery:
    """Apply a row-local transform to everything that has arrived, into parquet."""
    return (
        transform(requests)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_batches(
    requests: DataFrame, transform: Callable[[DataFrame], DataFrame], output: str, checkpoint: str
) -> StreamingQuery:
    """As ``run_available`` for transforms that join or aggregate, such as lemmas.

    Each micro-batch overwrites its own folder, so a replayed batch leaves no copies.
    """

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{output}/batch={number}")

    return (
        requests.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
