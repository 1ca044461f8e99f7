"""The pair features, as one row-local stage over cleaned pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinscope.functions import bags, fuzzy, text
from twinscope.operators.lemma import lemmatise

# Canonical order of the model inputs.
FEATURES = [
    "words_diff_q1_q2",
    "word_common",
    "word_total",
    "word_share",
    *bags.DISTANCES,
    *fuzzy.SCORES,
    "common_bigrams",
    "common_trigrams",
    "q1_readability_score",
    "q2_readability_score",
]
ALL_FEATURES = ["word_2_vec_diff", *FEATURES]


def clean_pairs(
    df: DataFrame, left: str, right: str, key: str, lemmas: DataFrame | None = None, drop_nulls: bool = True
) -> DataFrame:
    """Normalise both texts; with a lemma table, reduce nouns to their lemma.

    Batch work drops pairs with a null text; scoring keeps them as empty texts.
    """
    if drop_nulls:
        df = df.na.drop(subset=[left, right])
    df = df.withColumns({c: text.normalise(F.col(c)) for c in (left, right)})
    return df if lemmas is None else lemmatise(df, key, [left, right], lemmas)


def with_word_overlap(df: DataFrame, left: str, right: str) -> DataFrame:
    """Word-count difference, shared distinct words, total distinct words, share."""
    kept = df.columns
    df = df.withColumns({"_a": text.space_tokens(left), "_b": text.space_tokens(right)})
    df = df.withColumns(
        {
            "words_diff_q1_q2": F.abs(F.size("_a") - F.size("_b")).cast("long"),
            "word_common": F.size(F.array_intersect("_a", "_b")).cast("long"),
            "word_total": (F.size(F.array_distinct("_a")) + F.size(F.array_distinct("_b"))).cast("long"),
        }
    )
    share = F.col("word_common") / F.col("word_total")
    return df.withColumn("word_share", share).select(
        *kept, "words_diff_q1_q2", "word_common", "word_total", "word_share"
    )


def with_vectors(df: DataFrame, left: str, right: str) -> DataFrame:
    """The two integer vectors ``vec1`` and ``vec2`` of each pair."""
    kept = df.columns
    df = df.withColumns({"_w1": text.words(left), "_w2": text.words(right)})
    return bags.with_pair_vectors(df, "_w1", "_w2").select(*kept, "vec1", "vec2")


def with_distances(df: DataFrame, left: str, right: str) -> DataFrame:
    """The seven vector distances, all from one pair of vectors per row."""
    kept = df.columns
    df = df.withColumns({"_w1": text.words(left), "_w2": text.words(right)})
    df = df.withColumn("_sums", bags.vector_sums("_w1", "_w2"))
    return df.select(*kept, *[c.alias(n) for n, c in bags.distances().items()])


def with_minkowski(df: DataFrame, left: str, right: str, p: float) -> DataFrame:
    kept = df.columns
    df = with_vectors(df, left, right)
    return df.withColumn("minkowski_distance", bags.minkowski(F.col("vec1"), F.col("vec2"), p)).select(
        *kept, "minkowski_distance"
    )


def with_ngrams(df: DataFrame, left: str, right: str, n: int, name: str) -> DataFrame:
    kept = df.columns
    df = df.withColumns({"_w1": text.words(left), "_w2": text.words(right)})
    return df.withColumn(name, bags.common_ngrams("_w1", "_w2", n)).select(*kept, name)


def with_readability(df: DataFrame, left: str, right: str) -> DataFrame:
    return df.withColumns(
        {
            "q1_readability_score": text.readability(F.col(left)),
            "q2_readability_score": text.readability(F.col(right)),
        }
    )


def with_tfidf_cosine(df: DataFrame, left: str, right: str, max_features: int | None = None) -> DataFrame:
    """Cosine of the two texts' TF-IDF vectors, fitted on the pair itself.

    Words of two or more word characters; smoothed inverse document frequency over
    the two texts; with ``max_features`` the vocabulary keeps the words most frequent in
    both texts together, ties in byte order.
    """
    kept = df.columns
    word = r"[\p{L}\p{N}_]{2,}"
    df = df.withColumns(
        {f"_w{k}": F.regexp_extract_all(F.lower(F.col(c)), F.lit(word), F.lit(0)) for k, c in ((1, left), (2, right))}
    )
    return df.withColumn("tfidf_cosine", bags.tfidf_cosine("_w1", "_w2", max_features)).select(*kept, "tfidf_cosine")


def pair_features(df: DataFrame, left: str = "question1", right: str = "question2") -> DataFrame:
    """All features that need only the pair's own cleaned texts; one map stage, no shuffle."""
    kept = df.columns
    df = with_word_overlap(df, left, right)
    df = with_readability(df, left, right)
    df = df.withColumns({"_w1": text.words(left), "_w2": text.words(right)})
    # All kernels run side by side, so that a pair goes to Python once.
    kernels = {
        "_sums": bags.vector_sums("_w1", "_w2"),
        "common_bigrams": bags.common_ngrams("_w1", "_w2", 2),
        "common_trigrams": bags.common_ngrams("_w1", "_w2", 3),
    }
    df = fuzzy.with_fuzzy_scores(df, left, right, beside=kernels)
    df = df.withColumns(bags.distances())
    return df.select(*kept, *FEATURES)
