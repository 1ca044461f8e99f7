import random

import numpy as np
from pyspark.sql import functions as F

from twinscope.operators import tfidf, corpus, evaluate, joins, prepare, profile, ranking, sampling
from twinscope.sources import pairs as io


def test_running_totals_over_many_partitions(spark):
    values = list(range(500))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v, v % 7) for v in values], "k long, x long").repartition(9)
    out = ranking.with_running_totals(df, [F.col("k").desc()], {"n": F.lit(1).cast("long"), "s": F.col("x")})
    total = 0
    for i, r in enumerate(sorted(out.collect(), key=lambda r: -r["k"]), 1):
        total += r["x"]
        assert (r["n"], r["s"]) == (i, total)


def test_exact_samples_do_not_depend_on_layout(spark):
    df = spark.range(2000).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"))
    pick = lambda d: sorted(r["id"] for r in sampling.sample_per_class(d, "y", "id", {0: 311, 1: 57}, 5).collect())
    one, two = pick(df.repartition(1)), pick(df.repartition(7))
    assert one == two and len(one) == 368 and sum(i % 3 == 0 for i in one) == 57
    want = df.where("y = 1").orderBy(sampling.order_key("id", 5)).limit(57)
    assert {r["id"] for r in want.collect()} == {i for i in one if i % 3 == 0}
    assert len(sampling.sample_per_class(df, "y", "id", {1: 10**6}, 5).collect()) == 667


def test_folds_are_stratified(spark):
    df = spark.range(1003).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))
    sizes = sampling.with_folds(df, "y", "id", 5, 9).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        counts = [r["count"] for r in sizes if r["y"] == y]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_mirrored_pairs(spark):
    df = spark.createDataFrame([(1, 1, 2), (2, 2, 1), (3, 1, 2), (4, 5, 6), (5, 7, 7)], "id long, a long, b long")
    rows = {(r["id"], r["side"]): r["mirrored"] for r in profile.mirrored_pairs(df, "id", "a", "b").collect()}
    assert rows == {(3, 0): True, (1, 1): True, (2, 1): True, (3, 1): True, (5, 1): True}


def test_dictionary_join_with_hot_and_rare_words(spark):
    hot = joins.HOT_WORDS
    entries = spark.range(hot + 50).select(
        F.concat(F.lit("w"), "id").alias("word"), F.col("id").alias("idx"), (F.lit(10**6) - F.col("id")).alias("freq")
    )
    tokens = spark.createDataFrame(
        [(i, w) for i in range(40) for w in ("w0", f"w{hot + i}", "unknown")], "id long, word string"
    )
    rows = joins.dictionary_join(tokens, entries, "word").collect()
    assert len(rows) == 120
    for r in rows:
        assert r["idx"] == (None if r["word"] == "unknown" else int(r["word"][1:]))


def test_dictionary_join_with_a_hot_word_it_does_not_hold(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_WORDS", 1)
    entries = spark.createDataFrame([("a", 1), ("b", 2)], "word string, idx long")
    tokens = spark.createDataFrame([(i, "unknown") for i in range(50)] + [(50, "a"), (51, "b"), (52, None)], "id long, word string")
    rows = {r["id"]: r["idx"] for r in joins.dictionary_join(tokens, entries, "word").collect()}
    assert rows == {**{i: None for i in range(50)}, 50: 1, 51: 2, 52: None}


def test_nearest_word_against_brute_force(spark):
    rng = np.random.default_rng(4)
    table = rng.normal(size=(60, 5)).astype(np.float32)
    words = [f"w{i}" for i in range(60)]
    vectors = spark.createDataFrame(
        [(w, i + 1, 100 - i, [float(x) for x in v]) for i, (w, v) in enumerate(zip(words, table))],
        "word string, idx long, freq long, vector array<float>",
    )
    texts = {1: "w1 w2 w2 nothing", 2: "w9", 3: "nothing", 4: " ".join(words)}
    df = spark.createDataFrame(list(texts.items()), "qid long, question string")
    queries = joins.query_vectors(df, "qid", "question", vectors)
    got = {r["qid"]: r for r in joins.nearest_word(queries, vectors, "qid", block_words=7, shard_queries=1).collect()}
    unit = table.astype(float) / np.linalg.norm(table.astype(float), axis=1, keepdims=True)
    for qid in (1, 2):
        own = [int(w[1:]) for w in texts[qid].split() if w in words]
        mean = unit[own].mean(axis=0)
        scores = unit @ (mean / np.linalg.norm(mean))
        scores[own] = -np.inf
        assert got[qid]["word"] == words[int(scores.argmax())]
        assert abs(got[qid]["similarity"] - scores.max()) < 1e-9
    assert set(got) == {1, 2}
    pairs = spark.createDataFrame([(1, 1, 2), (2, 1, 3)], "id long, qid1 long, qid2 long")
    gaps = {r["id"]: r["word_2_vec_diff"] for r in joins.similarity_gap(pairs, joins.nearest_word(queries, vectors, "qid"), "qid1", "qid2").collect()}
    assert abs(gaps[1] - abs(got[1]["similarity"] - got[2]["similarity"])) < 1e-9 and gaps[2] == 999.0


def test_merged_sketches_estimate_distinct_values(spark):
    df = spark.range(60_000).selectExpr("id % 20000 AS a", "CASE WHEN id % 7 > 0 THEN id END AS b", "CAST(NULL AS STRING) AS c")
    columns = ["a", "b", "c"]
    exact = {r.column_name: r.n_distinct for r in profile.distinct_counts(df, columns).collect()}
    batches = [profile.distinct_sketches(df.where(f"id % 3 = {k}"), columns) for k in (0, 1, 1, 2)]
    merged = profile.merged_sketches(batches[0].union(batches[1]).union(batches[2]).union(batches[3]))
    got = {r.column_name: r.n_estimated for r in profile.sketched_counts(merged).collect()}
    assert exact["c"] == got["c"] == 1
    assert all(abs(got[c] / exact[c] - 1) < 0.03 for c in columns)
    assert profile.sketched_counts(profile.distinct_sketches(df.limit(0), columns)).count() == 0


def test_corpus_tfidf(spark):
    texts = {1: "aa bb bb", 2: "bb cc", 3: "cc dd dd", 4: "", 5: "x y"}
    docs = spark.createDataFrame([*texts.items(), (6, None)], "key long, text string")
    weighted = tfidf.sparse_vectors(docs, "key", "text")
    words = {k: [w for w in t.split() if len(w) > 1] for k, t in texts.items()}
    df = {w: sum(w in ws for ws in words.values()) for ws in words.values() for w in ws}
    vectors = {k: {w: ws.count(w) * (np.log(7 / (1 + df[w])) + 1) for w in ws} for k, ws in words.items()}
    norm = {k: sum(x * x for x in v.values()) ** 0.5 for k, v in vectors.items()}
    links = spark.createDataFrame([(1, 1, 2), (2, 2, 3), (3, 1, 3), (4, 1, 1), (5, 4, 1), (6, 6, 2)], "id long, l long, r long")
    got = {r.id: r.cosine for r in tfidf.pair_cosines(links, weighted, "key", "id", "l", "r").collect()}
    for i, a, b in ((1, 1, 2), (2, 2, 3), (4, 1, 1)):
        want = sum(x * vectors[b].get(w, 0) for w, x in vectors[a].items()) / (norm[a] * norm[b])
        assert abs(got[i] - want) < 1e-12
    assert got[3] == got[5] == got[6] == 0


def test_nearest_word_skips_cells_that_cannot_win(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(20, 8))
    table = (np.repeat(centres, 50, axis=0) + 0.05 * rng.normal(size=(1000, 8))).astype(np.float32)
    vectors = spark.createDataFrame(
        [(f"w{i}", i + 1, 1, [float(x) for x in v]) for i, v in enumerate(table)] + [("zero", 2000, 1, [0.0] * 8)], "word string, idx long, freq long, vector array<float>"
    )
    texts = {k: f"w{50 * k} w{50 * k + 1}" for k in range(20)}
    queries = joins.query_vectors(spark.createDataFrame(list(texts.items()), "qid long, question string"), "qid", "question", vectors)
    found = joins.searched(queries, vectors, "qid").collect()
    assert sum(r.skipped for r in found) > 0.7 * sum(r.cells for r in found)
    unit = table.astype(float) / np.linalg.norm(table.astype(float), axis=1, keepdims=True)
    got = {r.qid: r for r in joins.nearest_word(queries, vectors, "qid", block_words=300).collect()}
    for k in range(20):
        mean = unit[50 * k] + unit[50 * k + 1]
        scores = unit @ (mean / np.linalg.norm(mean))
        scores[[50 * k, 50 * k + 1]] = -np.inf
        assert got[k].word == f"w{scores.argmax()}" and abs(got[k].similarity - scores.max()) < 1e-9


def test_unique_questions_first_wins(spark):
    df = spark.createDataFrame([(2, 10, "late", 11, "b"), (1, 12, "c", 10, "early")], "id long, qid1 long, t1 string, qid2 long, t2 string")
    rows = {r["qid"]: r["question"] for r in joins.unique_questions(df, "id", [("qid1", "t1"), ("qid2", "t2")]).collect()}
    assert rows == {10: "early", 11: "b", 12: "c"}
    left = joins.pending(spark.createDataFrame([(1,), (2,)], "qid long"), spark.createDataFrame([(2,)], "qid long"), "qid")
    assert [r["qid"] for r in left.collect()] == [1]


def test_vocabulary_and_padding(spark):
    df = spark.createDataFrame([(1, "b a b"), (2, "c_d a !"), (3, "")], "id long, doc string")
    vocabulary = corpus.vocabulary_index(df, "id", "doc")
    assert {r["word"]: (r["idx"], r["freq"]) for r in vocabulary.collect()} == {"b": (1, 2), "a": (2, 2), "c": (3, 1), "d": (4, 1)}
    encoded = corpus.encode(df, "id", "doc", vocabulary)
    rows = {r["id"]: (r["seq"], r["p"]) for r in encoded.select("id", "seq", corpus.padded(F.col("seq"), 2).alias("p")).collect()}
    # a longer sequence is cut at the front
    assert rows == {1: ([1, 2, 1], [2, 1]), 2: ([3, 4, 2], [4, 2]), 3: ([], [0, 0])}


def test_auc_and_roc_against_definition(spark):
    rng = random.Random(2)
    rows = [(rng.randint(0, 1), rng.randint(0, 12) / 12) for _ in range(300)]
    df = spark.createDataFrame(rows, "y int, s double")
    pos, neg = ([s for y, s in rows if y == k] for k in (1, 0))
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(evaluate.auc(df, "y", "s").first()["auc"] - want) < 1e-12
    points = evaluate.roc_points(df, "y", "s").collect()
    for r in points:
        assert abs(r["tpr"] - sum(p >= r["threshold"] for p in pos) / len(pos)) < 1e-12
        assert abs(r["fpr"] - sum(n >= r["threshold"] for n in neg) / len(neg)) < 1e-12


def test_rates_with_empty_denominators(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, z int")
    r = evaluate.rates(df, "y", "z").first()
    assert (r["sensitivity"], r["precision"], r["specificity"], r["false_positive_rate"]) == (None, None, 1.0, 0.0)
    assert evaluate.confusion(df, "y", "z").count() == 4


def test_standardise_and_repair(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (float("nan"), 5.0)], "a double, b double")
    fitted = prepare.Standardizer.fit(df, ["a", "b"])
    assert fitted.mean == {"a": 2.0, "b": 5.0} and fitted.deviation == {"a": 1.0, "b": 1.0}
    out = prepare.repair(fitted.transform(df), ["a", "b"]).collect()
    assert [tuple(r) for r in out] == [(-1.0, 0.0), (1.0, 0.0), (0.0, 0.0)]
    inf = spark.createDataFrame([(float("inf"),), (float("-inf"),)], "a double")
    assert [r["a"] for r in prepare.repair(inf, ["a"]).collect()] == [prepare.MAX_DOUBLE, -prepare.MAX_DOUBLE]


def test_csv_with_quotes_newlines_and_null_tokens(spark, tmp_path):
    rows = [(1, 1, 2, 'say "hi",\nthere ', "NaN", 0), (2, 3, 4, None, " plain", 1)]
    path = str(tmp_path / "pairs")
    io.write_pairs_csv(spark.createDataFrame(rows, io.PAIR_SCHEMA), path)
    back = sorted(tuple(r) for r in io.read_pairs_csv(spark, path).collect())
    assert back == [(1, 1, 2, 'say "hi",\nthere ', None, 0), (2, 3, 4, None, " plain", 1)]


def test_word_vector_text(spark, tmp_path):
    path = tmp_path / "vectors.txt"
    path.write_text("the 0.5 -1.25\ncafé 3 4e-2\n")
    rows = {r["word"]: [round(x, 4) for x in r["vector"]] for r in io.read_word_vectors(spark, str(path)).collect()}
    assert rows == {"the": [0.5, -1.25], "café": [3.0, 0.04]}


def test_query_vectors_are_summed_where_the_words_are(spark):
    """A shard of questions gets each of its words' vectors once: nothing else with a vector is shuffled.
    Repeated and null keys, and words with several vectors, are summed as before."""
    vectors = spark.createDataFrame(
        [("a", [3.0, 4.0]), ("b", [0.0, 2.0]), ("b", [5.0, 0.0]), ("zero", [0.0, 0.0]), ("none", None)], "word string, vector array<float>"
    )
    rows = [(1, "a a x"), (1, "zero"), (2, "b"), (None, "a"), (None, "b"), (3, "x"), (4, ""), (5, None), (6, "none"), (7, "zero")]
    df = spark.createDataFrame(rows, "qid long, question string")
    for shard_words in (1, 1000):
        got = {r.qid: r for r in joins.query_vectors(df, "qid", "question", vectors, shard_words).collect()}
        assert set(got) == {1, 2, None, 7}
        want = {1: (0.6, 0.8, ["a", "zero"]), 2: (0.5**0.5, 0.5**0.5, ["b"]), 7: (0.0, 0.0, ["zero"])}
        norm = (1.6**2 + 1.8**2) ** 0.5  # (3, 4) / 5 and both of b
        want[None] = (1.6 / norm, 1.8 / norm, ["a", "b"])
        for key, (x, y, own) in want.items():
            assert np.allclose(got[key].query, [x, y]) and got[key].own == own
    many = spark.range(2000).select(F.col("id").alias("qid"), F.lit("a b a b").alias("question"))
    plan = joins.query_vectors(many, "qid", "question", vectors)
    plan.collect()
    executed = plan._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in executed and "summarizer" not in executed.lower()
