"""TF-IDF over a whole corpus: weights by document and word, and cosines of pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinscope.operators.joins import dictionary_join
from twinscope.sources.scratch import written

#: Words are runs of two or more word characters.
WORD = r"[\p{L}\p{N}_]{2,}"


def term_counts(docs: DataFrame, key: str, column: str) -> DataFrame:
    """``(key, terms)``: the distinct words of each document with their counts, in order of the
    word, from one sort per text. Nothing is shuffled. A null text has no words."""
    words = F.regexp_extract_all(F.lower(F.coalesce(column, F.lit(""))), F.lit(WORD), F.lit(0))
    counted = docs.select(key, F.sort_array(words).alias("_w")).withColumn("_n", F.size("_w"))
    starts = F.filter(
        F.when(F.col("_n") > 0, F.sequence(F.lit(0), F.col("_n") - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: (i == 0) | (F.get("_w", i) != F.get("_w", i - 1)),
    )
    counted = counted.withColumn("_at", starts)
    ends = F.concat(F.slice("_at", F.lit(2), F.col("_n")), F.array("_n"))
    return counted.select(
        key,
        F.zip_with(
            F.col("_at"),
            F.slice(ends, F.lit(1), F.size("_at")),
            lambda a, b: F.struct(F.get("_w", a).alias("word"), (b - a).alias("tf")),
        ).alias("terms"),
    )


def document_frequencies(counts: DataFrame) -> DataFrame:
    """``(word, df)`` from written term counts; partial sums are made before the shuffle."""
    return counts.select(F.explode("terms.word").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))


def sparse_vectors(docs: DataFrame, key: str, column: str) -> DataFrame:
    """``(key, terms, weights)``: word numbers of each document in order and their weights, which
    are tf times ln((1 + n) / (1 + df)) + 1 over the length of the whole vector. ``key`` is unique.

    ``n`` counts all documents, those without words (which have no row here) included.
    Counts are written once for both passes over them, and frequencies with a number for each word.
    Frequent words are looked up in place, the others by a shuffled join; no vector is wider than
    its document.
    """
    counts = written(term_counts(docs, key, column), "term-counts")
    known = written(document_frequencies(counts).withColumn("term", F.monotonically_increasing_id()), "document-frequencies")
    n = counts.count()
    idf = (F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0).alias("idf")
    entries = known.select("word", "term", idf)
    tokens = counts.select(key, F.explode("terms").alias("t")).select(key, "t.word", "t.tf")
    found = dictionary_join(tokens, entries, "word", known.select("word", F.col("df").alias("_n")))
    raw = found.select(key, "term", (F.col("tf") * F.col("idf")).alias("raw"))
    whole = raw.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("term", "raw"))).alias("_v"), F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("_length")
    )
    return whole.select(key, F.col("_v.term").alias("terms"), F.transform("_v.raw", lambda x: x / F.col("_length")).alias("weights"))


def pair_cosines(links: DataFrame, vectors: DataFrame, key: str, pair: str, left: str, right: str) -> DataFrame:
    """``(pair, cosine)`` of all links ``(pair, left, right)``; pairs without a common word have 0.

    The two vectors of a pair, one row each, are merged by one sort: equal word numbers lie
    side by side then. No row per word is made.
    """
    for n, own in (("1", left), ("2", right)):
        side = vectors.select(F.col(key).alias(own), F.col("terms").alias(f"_t{n}"), F.col("weights").alias(f"_w{n}"))
        links = links.join(side, own, "left")
    # Term and weight are put together after the joins: an array of structs is twice as large as two arrays.
    entries = [F.arrays_zip(F.col(f"_t{n}").alias("t"), F.col(f"_w{n}").alias("w")) for n in ("1", "2")]
    merged = links.select(pair, F.sort_array(F.concat(*entries)).alias("_m"))
    width = F.greatest(F.size("_m") - 1, F.lit(0))
    products = F.zip_with(
        F.slice("_m", F.lit(1), width), F.slice("_m", F.lit(2), width), lambda a, b: F.when(a["t"] == b["t"], a["w"] * b["w"]).otherwise(0.0)
    )
    return merged.select(pair, F.coalesce(F.aggregate(products, F.lit(0.0), lambda a, x: a + x), F.lit(0.0)).alias("cosine"))
