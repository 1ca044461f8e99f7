"""Noun lemmas from a lexicon table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinscope.functions import text
from twinscope.sources.pairs import spread_by

# Plural endings of nouns and what they stand for.
SUFFIX_RULES = [
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
]

#: Every form of a lemma table without exceptions ends in one of these.
ENDINGS = [a for a, _ in SUFFIX_RULES if not any(a != b and a.endswith(b) for b, _ in SUFFIX_RULES)]


def lemma_table(lexicon: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """``(word, lemma)`` for every surface form that has a different lemma.

    The rules are run backwards over the lexicon, so the table depends on the
    lexicon alone and no pass over the corpus is needed to build it. The lemma is
    the shortest known form, then the first in byte order.
    """
    lexicon = lexicon.select("word").distinct()
    forms = F.filter(
        F.array(
            *[
                F.when(
                    F.col("word").endswith(base),
                    F.concat(F.expr(f"left(word, length(word) - {len(base)})"), F.lit(suffix)),
                )
                for suffix, base in SUFFIX_RULES
            ]
        ),
        lambda w: w.isNotNull(),
    )
    found = lexicon.select(F.explode(F.array_distinct(forms)).alias("form"), F.col("word").alias("lemma"))
    if exceptions is not None:
        known = exceptions.select("word", "lemma").join(lexicon.select(F.col("word").alias("lemma")), "lemma", "left_semi")
        itself = (
            exceptions.select("word").join(lexicon, "word", "left_semi").select("word", F.col("word").alias("lemma"))
        )
        # an exception replaces the suffix rules for its word
        found = found.join(exceptions.select(F.col("word").alias("form")), "form", "left_anti")
        found = found.unionByName(known.unionByName(itself).withColumnRenamed("word", "form"))
    best = found.groupBy("form").agg(
        F.min(F.struct(F.length("lemma").alias("n"), F.col("lemma"))).alias("best")
    )
    return best.select(F.col("form").alias("word"), F.col("best.lemma").alias("lemma")).where(
        F.col("word") != F.col("lemma")
    )


def lemmatise(df: DataFrame, key: str, columns: list[str], lemmas: DataFrame, endings: list[str] | None = None) -> DataFrame:
    """Replace each word of the text columns by its lemma; ``key`` is unique.

    Only the distinct words of a row meet the lemma table, and only those that
    change come back, as one small map per row. With ``endings`` (``ENDINGS`` for a table
    without exceptions) words that end in none of them stay and aren't looked up. The join is left to AQE: the lemma
    table is broadcast while its measured size allows, else the join is sort-merge
    with skewed words split.
    """
    # An inner explode would get a filter on the size of its array, which computes the words twice.
    distinct = F.array_distinct(F.flatten(F.array(*[text.words(text.fill_empty(c)) for c in columns])))
    asked = df.select(key, F.explode_outer(distinct).alias("word"))
    if endings is not None:
        asked = asked.where(reduce(Column.__or__, [F.col("word").endswith(e) for e in endings], F.lit(False)))
    found = (
        asked.join(lemmas.select("word", "lemma"), "word")
        .groupBy(key)
        .agg(F.map_from_entries(F.collect_list(F.struct("word", "lemma"))).alias("_lemmas"))
    )
    joined = spread_by(df, key).join(found, key, "left")
    return joined.withColumns(
        {
            c: F.array_join(
                F.transform(
                    text.words(F.col(c)),
                    lambda w: F.coalesce(F.try_element_at(F.col("_lemmas"), w), w),
                ),
                " ",
            )
            for c in columns
        }
    ).drop("_lemmas").select(*df.columns)
