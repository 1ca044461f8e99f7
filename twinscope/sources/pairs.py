"""Readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAIR_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("qid1", T.LongType()),
        T.StructField("qid2", T.LongType()),
        T.StructField("question1", T.StringType()),
        T.StructField("question2", T.StringType()),
        T.StructField("is_duplicate", T.IntegerType()),
    ]
)

# Spellings that a data-frame CSV reader takes for a missing value.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_pairs_csv(spark: SparkSession, path: str) -> DataFrame:
    """Labelled pairs; quoted texts may hold newlines and doubled quotes."""
    df = (
        spark.read.schema(PAIR_SCHEMA)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    return df.withColumns(
        {c: F.when(~F.col(c).isin(NULL_TOKENS), F.col(c)) for c in ("question1", "question2")}
    )


def write_pairs_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("quote", '"').option("escape", '"').option("quoteAll", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_features(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_word_vectors(spark: SparkSession, path: str, dim: int | None = None) -> DataFrame:
    """``word v1 .. vn`` per line.

    Lines that hold something else than numbers after the word are skipped, and so are lines
    without any number; with ``dim`` also those of another length, such as a header line.
    """
    parts = F.split("value", " ")
    numbers = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: x.try_cast("float"))
    vectors = spark.read.text(path).select(F.element_at(parts, 1).alias("word"), numbers.alias("vector"))
    whole = (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull())
    return vectors.where(whole if dim is None else whole & (F.size("vector") == dim))


def write_word_vectors(df: DataFrame, path: str) -> None:
    line = F.concat_ws(" ", F.col("word"), F.transform("vector", lambda x: x.cast("string")))
    df.select(line.alias("value")).write.text(path)


def repartitioned(df: DataFrame, n: int) -> DataFrame:
    return df.repartition(n)


def spread_by(df: DataFrame, *keys: str) -> DataFrame:
    """Hash layout in exactly ``spark.sql.shuffle.partitions`` parts.

    A fixed number keeps AQE from packing the parts by bytes: the stages that follow
    cost by the square of a text's length, so few bytes may still be much work. A join
    or aggregate on the same keys reuses the layout.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
