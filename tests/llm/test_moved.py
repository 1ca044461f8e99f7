"""Joins of texts move only those that can have a partner."""

from pyspark.sql import functions as F

from twinscope.llm import linededup, neardup, substrings


def watched(monkeypatch, module):
    """How many rows each call lets through."""
    seen = []

    def counted(df, wanted, key, n, outside=False):
        out = linededup.maybe_in(df, wanted, key, n, outside)
        seen.append((outside, out.count()))
        return out

    monkeypatch.setattr(module, "maybe_in", counted, raising=False)
    return seen


def some_docs(spark):
    """2000 texts of their own words, ten of them twice."""
    own = spark.range(2000).select("id", F.array_join(F.transform(F.sequence(F.lit(0), F.lit(60)), lambda k: F.sha1(F.concat_ws("-", "id", k))), " ").alias("text"))
    again = own.where("id < 10").select((F.col("id") + 5000).alias("id"), F.concat("text", F.lit(" end")).alias("text"))
    return own.unionByName(again).withColumnRenamed("id", "doc_id")


def test_near_duplicates(spark, monkeypatch):
    seen = watched(monkeypatch, neardup)
    docs = some_docs(spark)
    rows = neardup.near_duplicates(docs, width=3, percent=85).where("component_id <> doc_id").collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == [(5000 + k, k) for k in range(10)]
    assert seen and all(20 <= n < 500 for _, n in seen)


def test_repeats(spark, monkeypatch):
    seen = watched(monkeypatch, substrings)
    out = {r.doc_id: r.n_removed for r in substrings.remove_repeats(some_docs(spark)).collect()}
    assert {i for i, n in out.items() if n} == {*range(10), *range(5000, 5010)} and len(out) == 2010
    (inside,), (outside,) = [n for o, n in seen if not o], [n for o, n in seen if o]
    assert inside < 500 and inside + outside == 2010


def test_the_map_splits_rows(spark, monkeypatch):
    rows = spark.createDataFrame([(k,) for k in (*range(100), 1, None, None)], "k long")
    wanted = rows.where("k < 5")
    for most in (1 << 26, 1 << 4, 0):
        monkeypatch.setattr(linededup, "MOST_BITS", most)
        inside, outside = (linededup.maybe_in(rows, wanted, "k", 6, outside=o).collect() for o in (False, True))
        assert len(inside) + len(outside) == 103 and {0, 1, 2, 3, 4} <= {r.k for r in inside}
