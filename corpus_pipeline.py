"""The training-data pipeline: documents to packed sequences in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the
last return the columns of ``documents``. Nulls, ties and empty tables are treated as the
operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinscope.llm.decontaminate import find_contamination
from twinscope.llm.linededup import dedup_lines
from twinscope.llm.neardup import near_duplicates
from twinscope.llm.packing import pack
from twinscope.llm.toxicity import score_toxicity, train
from twinscope.sources.scratch import scratch_path

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from all labelled documents."""
    source = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    net = train(source, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(docs, net).where("not rejected").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand in an earlier one; ``n_chars`` follows the text.

    A document all of whose words stood in repeated lines is a copy, and goes.
    """
    cut = dedup_lines(docs.select(*docs.columns))
    empty = (F.col("n_dropped") > 0) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    changed = F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.where(F.coalesce(~empty, F.lit(True))).withColumn("n_chars", changed).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, a similarity of 0.8 or more."""
    return near_duplicates(docs, width=5, percent=80).where("kept").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ten words of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_contamination(docs, items).where("n_hit = 0").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the kept documents in sequences of 2048."""
    return pack(docs.select("doc_id", "text"), length=2048, end_id=1)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: A trained classifier has no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each reads what its predecessor wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*DOCUMENTS)
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name.replace(' ', '-')}")
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
