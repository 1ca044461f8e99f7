"""Registered queries: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinscope.llm import balltree, whitening
from twinscope.llm.chat import format_chats, read_back
from twinscope.llm.decontaminate import find_contamination
from twinscope.llm.fingerprint import as_string, compare_with_next
from twinscope.llm.linededup import dedup_lines
from twinscope.llm.neardup import near_duplicates
from twinscope.llm.packing import pack
from twinscope.llm.reputation import judge_urls
from twinscope.llm.sharding import external_shuffle
from twinscope.llm.substrings import remove_repeats
from twinscope.llm.tokencount import count_tokens
from twinscope.llm.toxicity import CUT, score_toxicity, train


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out() -> Column:
    """A third of all documents, by a checksum of the id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = train(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return score_toxicity(docs, net).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "threshold", "rejected"
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = compare_with_next(table(spark, sf_dir, "documents"))
    return compared.select(
        "doc_id",
        F.col("chars").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_string(F.col("tree")).alias("fingerprint"),
        as_string(F.col("edited_tree")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    shuffled = external_shuffle(docs, n_shards=8, seed=7)
    text = F.coalesce("text", F.lit(""))
    return shuffled.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = find_contamination(docs.select("doc_id", "text"), items, width=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, width=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "text")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents").select("doc_id", "text"), length=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=400)
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return cut.select("doc_id", n_bytes.alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    known = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return read_back(format_chats(turns.unionByName(known)))


URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op10_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"))
    return judge_urls(pages, outcomes, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return balltree.search(docs.select("doc_id", "text"), items, top=20)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(rows, k=4)
    shares = model.values / model.trace if len(model.values) else []
    parts = F.array(*[F.struct(F.lit(k + 1).alias("component"), F.get("whitened", F.lit(k)).alias("whitened"), F.lit(float(e)).alias("explained")) for k, e in enumerate(shares)])
    empty = F.array().cast("array<struct<component:int,whitened:double,explained:double>>")
    out = whitening.transform(rows, model).withColumn("c", F.explode(parts if len(shares) else empty))
    return out.select("vec_id", "c.component", F.lit(model.n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained", F.lit(model.identity_error).alias("identity_error"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return count_tokens(docs).select("doc_id", n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_fingerprints": op2_fingerprints,
    "op3_sharding": op3_sharding,
    "op4_decontamination": op4_decontamination,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_line_dedup": op6_line_dedup,
    "op7_packing": op7_packing,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_chat_format": op9_chat_format,
    "op10_url_reputation": op10_url_reputation,
    "op11_lexical_search": op11_lexical_search,
    "op12_whitening": op12_whitening,
    "op13_token_counts": op13_token_counts,
}
