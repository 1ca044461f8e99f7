"""Toxicity learns from all labelled rows, by several workers, and its thresholds are exact."""

import random

import numpy as np
from pyspark.sql import functions as F

from twinscope.llm import toxicity


def labelled(spark, texts):
    docs = spark.createDataFrame([(i, t, "en") for i, (t, _) in enumerate(texts)], "doc_id long, text string, lang string")
    return docs, spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id long, toxic int")


def test_words_of_any_labelled_row_are_learned(spark):
    """A fit once took the 3000 rows of a class with the least hashes."""
    ids = [r.id for r in spark.range(3400).orderBy(F.xxhash64(F.lit(11), "id"), "id").collect()]
    late = set(ids[-60:])
    rng = random.Random(1)
    words = [f"word{k}" for k in range(50)]
    texts = [(" ".join([*rng.choices(words, k=4), "vile" if i in late else "awful"]), 1) for i in range(3400)]
    texts += [(" ".join(rng.choices(words, k=5)), 0) for _ in range(400)]
    docs, labels = labelled(spark, texts)
    assert toxicity._labelled(docs, labels, "text", "doc_id").count() == 3800
    net = toxicity.train(docs, labels)
    ids, _ = toxicity.word_ids(np.frombuffer(b"vile", np.uint8), np.array([0, 4]))
    assert (net.embedding[ids[0, 0]] != 0).any()
    scored = toxicity.score_toxicity(spark.createDataFrame([(1, "vile")], "doc_id long, text string"), net)
    assert scored.first().score > toxicity.CUT


def test_several_workers(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "WORKER_ROWS", 400)
    rng = random.Random(2)
    words = [f"word{k}" for k in range(300)]
    texts = [(" ".join(rng.choices(words, k=30) + (["awful"] if i % 9 == 0 else [])), int(i % 9 == 0)) for i in range(2000)]
    docs, labels = labelled(spark, texts)
    rows = toxicity._labelled(docs, labels, "text", "doc_id")
    assert rows.select("worker").distinct().count() == 5
    nets = [toxicity.train(docs, labels) for _ in range(2)]
    assert nets[0].centre == nets[1].centre and (nets[0].embedding == nets[1].embedding).all()
    wrong = toxicity.score_toxicity(docs, nets[0]).join(labels, "doc_id").where((F.col("score") >= toxicity.CUT).cast("int") != F.col("toxic"))
    assert wrong.count() < 10


def test_thresholds_are_the_best_over_all_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(g, round(float(v), 1), int(v + rng.normal(0, 2) > 1)) for g in ("a", "b") for v in rng.normal(0, 2, 300)]
    rows += [("none", float(k), 0) for k in range(3)] + [("one", 1.5, 1)]
    got = toxicity.best_thresholds(spark.createDataFrame(rows, "group string, value double, toxic int"))
    for group in ("a", "b", "none", "one"):
        own = [(v, t) for g, v, t in rows if g == group]
        best = max(v for v, _ in own) + 1
        top = 0.0
        values = sorted({v for v, _ in own}, reverse=True)
        for k, cut in enumerate(values):
            over = [t for v, t in own if v >= cut]
            f1 = 2 * sum(over) / (len(over) + sum(t for _, t in own))
            if 2 * sum(over) >= len(over) and f1 > top:
                top, best = f1, (cut + (values[k + 1] if k + 1 < len(values) else cut - 1)) / 2
        assert abs(got[group] - best) < 1e-12


def test_labelled_texts_are_moved_once(spark, monkeypatch):
    """Where the labels were too many to broadcast, texts once went through the join's shuffle and the workers'."""
    rows = [(i, f"text {i}", "en") for i in range(60)] + [(7, "another text 7", "de"), (8, None, None), (None, "no id", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 50)] + [(7, 1), (90, 1), (None, 0), (51, None)], "doc_id long, toxic int")
    plans, write = {}, toxicity.written

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        return write(df, name)

    monkeypatch.setattr(toxicity, "written", watched)
    monkeypatch.setattr(toxicity, "WORKER_ROWS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = toxicity._labelled(docs, labels, "text", "doc_id").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moves = [part for part in plans["labelled"].split("\n\n") if ") Exchange" in part and "text#" in part]
    assert len(moves) == 1
    want = [(t or "", g or "", int(i % 2)) for i, t, g in rows if i is not None and i < 50]
    assert sorted((r.text, r.lang, r.toxic) for r in got) == sorted(want)
    assert len({r.worker for r in got}) > 1 and {r.held for r in got} == {True, False}
