"""Pair tables derived from the given tables: whole tables, whole texts.

Both use equi-joins on unique keys or on one row per key, so their size is linear
in the input. Copies of one document may be many: they are never paired with each
other, only each with the first of its group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinscope.functions import text
from twinscope.operators.ranking import with_row_number
from twinscope.sources.pairs import repartitioned, spread_by
from twinscope.sources.scratch import kept


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_even_parts(df: DataFrame) -> DataFrame:
    """A table whose rows are costly to process, in as many parts as there are cores at least."""
    return repartitioned(df, max(df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()))


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return in_even_parts(table(spark, sf_dir, name))


def kept_table(spark: SparkSession, sf_dir: str, name: str, sources: list[str], build) -> DataFrame:
    """A table made from the given ones, written once for all queries of an application."""
    return kept(spark, name, [f"{sf_dir}/{s}.parquet" for s in sources], build)


def with_texts(links: DataFrame, texts: DataFrame, how: str = "inner") -> DataFrame:
    """Put the texts ``(key, text)`` of both sides to narrow pairs ``(id, qid1, qid2, is_duplicate)``.

    A much-copied document leaves its pairs in one task; the stages that follow cost far more
    than moving the rows once, and joins on the pair id reuse the layout.
    """
    for side in ("1", "2"):
        own = texts.select(F.col("key").alias(f"qid{side}"), F.col("text").alias(f"question{side}"))
        links = links.join(own, f"qid{side}", how)
    return spread_by(links.select("id", "qid1", "qid2", "question1", "question2", "is_duplicate"), "id")


def document_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_table(spark, sf_dir, "document-links", ["documents"], lambda: _document_links(spark, sf_dir))


def _document_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the next one, and with the first document that shares its
    first line, its last line, or its whole text. Duplicates end in the same line.
    Only ids and digests are moved."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(F.lower(F.split_part("text", F.lit("\n"), F.lit(1)))).alias("opening"),
        F.md5(F.lower(F.split_part("text", F.lit("\n"), F.lit(-1)))).alias("ending"),
        F.md5("text").alias("digest"),
    )

    def with_first(group: str, slot: int, doc_side: str, first_side: str) -> DataFrame:
        firsts = docs.groupBy(group).agg(F.min("doc_id").alias("first"))
        joined = docs.select("doc_id", group).join(firsts, group).where(F.col("first") < F.col("doc_id"))
        return joined.select(
            (F.col("doc_id") * 4 + slot).alias("id"),
            F.col("doc_id").alias(doc_side),
            F.col("first").alias(first_side),
        )

    after = docs.select((F.col("doc_id") - 1).alias("doc_id"))
    pairs = docs.select("doc_id").join(after, "doc_id").select(
        (F.col("doc_id") * 4).alias("id"), F.col("doc_id").alias("qid1"), (F.col("doc_id") + 1).alias("qid2")
    )
    for group, slot, doc_side, first_side in (
        ("opening", 1, "qid1", "qid2"),
        ("ending", 2, "qid2", "qid1"),
        ("digest", 3, "qid1", "qid2"),
    ):
        pairs = pairs.unionByName(with_first(group, slot, doc_side, first_side))
    side1 = docs.select(F.col("doc_id").alias("qid1"), F.col("ending").alias("e1"))
    side2 = docs.select(F.col("doc_id").alias("qid2"), F.col("ending").alias("e2"))
    return pairs.join(side1, "qid1").join(side2, "qid2").select(
        "id", "qid1", "qid2", (F.col("e1") == F.col("e2")).cast("int").alias("is_duplicate")
    )


def documents_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "text")


def document_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_texts(document_links(spark, sf_dir), documents_by_key(spark, sf_dir))


def numbered_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages with their number ``n`` from 1 in the order of conversation and turn.

    However many turns a conversation has, no two messages share a number.
    """

    def build() -> DataFrame:
        rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
        return with_row_number(rows, [F.col(c) for c in ("conv_id", "turn", "role", "text")], "n")

    return kept_table(spark, sf_dir, "messages", ["conversations"], build)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message with its number as ``key``."""
    return in_even_parts(numbered_messages(spark, sf_dir)).select(F.col("n").alias("key"), "conv_id", "turn", "role", "text")


def turn_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each message with the next and the next but one of its conversation.
    Duplicates come from the same role."""
    rows = numbered_messages(spark, sf_dir).select("conv_id", "turn", "role", "n")
    first = rows.select("conv_id", "turn", F.col("role").alias("r1"), F.col("n").alias("qid1"), F.explode(F.array(F.lit(1), F.lit(2))).alias("step"))
    first = first.withColumn("turn2", F.col("turn") + F.col("step"))
    second = rows.select("conv_id", F.col("turn").alias("turn2"), F.col("role").alias("r2"), F.col("n").alias("qid2"))
    return first.join(second, ["conv_id", "turn2"]).select(
        (F.col("qid1") * 2 + F.col("step") - 1).alias("id"), "qid1", "qid2", (F.col("r1") == F.col("r2")).cast("int").alias("is_duplicate")
    )


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_texts(turn_links(spark, sf_dir), messages(spark, sf_dir).select("key", "text"))


def open_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each message with the next one, including before the first and after the last of a
    conversation, where one side has no text. Places are numbered here: a message has four times
    its number, the empty places before and after it one less and one more."""
    rows = numbered_messages(spark, sf_dir).select("conv_id", "turn", "role", (F.col("n") * 4).alias("place"))
    left = rows.select("conv_id", (F.col("turn") + 1).alias("at"), F.col("role").alias("r1"), F.col("place").alias("p1"))
    right = rows.select("conv_id", F.col("turn").alias("at"), F.col("role").alias("r2"), F.col("place").alias("p2"))
    qid1, qid2 = F.coalesce("p1", F.col("p2") - 1), F.coalesce("p2", F.col("p1") + 1)
    return left.join(right, ["conv_id", "at"], "full").select(
        qid1.alias("id"), qid1.alias("qid1"), qid2.alias("qid2"), F.coalesce((F.col("r1") == F.col("r2")).cast("int"), F.lit(0)).alias("is_duplicate")
    )


def with_open_texts(links: DataFrame, texts: DataFrame, how: str = "left") -> DataFrame:
    """``with_texts`` for ``open_links``, from texts by message number."""
    return with_texts(links, texts.select((F.col("key") * 4).alias("key"), "text"), how)


def open_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_open_texts(open_links(spark, sf_dir), messages(spark, sf_dir).select("key", "text"))


def normalised_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(key, text)``: every document normalised once, for the lexicon and the cleaned texts."""

    def build() -> DataFrame:
        docs = text_table(spark, sf_dir, "documents").where(F.col("text").isNotNull())
        return docs.select(F.col("doc_id").alias("key"), text.normalise(F.col("text")).alias("text"))

    return kept_table(spark, sf_dir, "normalised-documents", ["documents"], build)


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that occur at least twice in the documents.

    An inner explode would get a filter on the size of its array, which computes the words twice."""
    # Normalised words have one space between them.
    words = normalised_documents(spark, sf_dir).select(F.explode_outer(text.space_tokens("text")).alias("word"))
    return words.where(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 2).select("word")
