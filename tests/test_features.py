import math

from pyspark.sql import functions as F

from twinscope.functions import bags
from twinscope.operators import features as fe

Q = ("question1", "question2")


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def cleaned(edge_pairs):
    return fe.clean_pairs(edge_pairs, *Q, "id", drop_nulls=False)


def test_cleaning(edge_pairs):
    assert 1 not in by_id(fe.clean_pairs(edge_pairs, *Q, "id"))
    rows = by_id(cleaned(edge_pairs))
    assert rows[1]["question1"] == ""
    assert rows[7]["question1"] == "what is the café"
    assert rows[10]["question1"] == "one two three"
    assert rows[9]["question1"] == rows[9]["question2"] == ""


def test_overlap(edge_pairs):
    rows = by_id(fe.with_word_overlap(cleaned(edge_pairs), *Q))
    assert rows[2]["word_share"] == 0.5 and rows[2]["word_total"] == 2
    assert rows[5]["words_diff_q1_q2"] == 2 and rows[5]["word_common"] == 2
    assert rows[12]["word_common"] == 1 and rows[12]["word_total"] == 5


def test_vectors(edge_pairs):
    rows = by_id(fe.with_vectors(cleaned(edge_pairs), *Q))
    assert (rows[3]["vec1"], rows[3]["vec2"]) == ([1, 2], [0, 0])
    assert rows[4]["vec1"] == rows[4]["vec2"] == [0, 0, 0, 1, 1, 2]
    assert rows[2]["vec1"] == rows[2]["vec2"] == []
    # vocabulary: go, going, gonna, to
    assert rows[12]["vec1"] == [0, 0, 0, 1, 3] and rows[12]["vec2"] == [0, 0, 1, 2, 4]


def test_distances(edge_pairs):
    rows = by_id(fe.with_distances(cleaned(edge_pairs), *Q))
    assert math.isnan(rows[2]["cosine_distance"]) and math.isnan(rows[3]["cosine_distance"])
    assert math.isnan(rows[2]["braycurtis_distance"]) and rows[2]["jaccard_distance"] == rows[2]["canberra_distance"] == 0
    assert rows[3]["canberra_distance"] == 2 and rows[3]["cityblock_distance"] == 3
    assert all(rows[4][n] < 1e-12 for n in bags.DISTANCES)
    assert all(rows[6][n] < 1e-12 for n in bags.DISTANCES)
    u, v = [0, 0, 0, 1, 3], [0, 0, 1, 2, 4]
    assert rows[12]["jaccard_distance"] == 1.0
    assert abs(rows[12]["cosine_distance"] - (1 - 14 / math.sqrt(10 * 21))) < 1e-12
    assert abs(rows[12]["canberra_distance"] - sum(abs(a - b) / (a + b) for a, b in zip(u, v) if a + b)) < 1e-12
    assert abs(rows[12]["braycurtis_distance"] - 3 / 11) < 1e-12


def test_minkowski_of_order_two_is_euclidean(edge_pairs):
    df = cleaned(edge_pairs)
    two = by_id(fe.with_minkowski(df, *Q, 2.0))
    for i, r in by_id(fe.with_distances(df, *Q)).items():
        assert abs(r["euclidean_distance"] - two[i]["minkowski_distance"]) < 1e-12
        assert r["euclidean_distance"] == r["minkowski_distance"]


def test_ngrams_count_one_side(edge_pairs):
    df = cleaned(edge_pairs)
    assert by_id(fe.with_ngrams(df, *Q, 2, "n"))[5]["n"] == 2
    assert by_id(fe.with_ngrams(df, "question2", "question1", 2, "n"))[5]["n"] == 1
    assert by_id(fe.with_ngrams(df, *Q, 3, "n"))[10]["n"] == 1
    assert by_id(fe.with_ngrams(df, *Q, 3, "n"))[3]["n"] == 0


def test_symmetric_features(edge_pairs):
    df = cleaned(edge_pairs)
    names = ["word_common", "word_share", *bags.DISTANCES]
    shown = lambda d: d.select("id", *[F.when(F.isnan(n), -1).otherwise(F.round(n, 9)).alias(n) for n in names])
    one = shown(fe.with_distances(fe.with_word_overlap(df, *Q), *Q))
    two = shown(fe.with_distances(fe.with_word_overlap(df, *Q[::-1]), *Q[::-1]))
    assert one.exceptAll(two).count() == 0


def test_tfidf(edge_pairs):
    rows = by_id(fe.with_tfidf_cosine(cleaned(edge_pairs), *Q))
    idf = 1 + math.log(1.5)
    # gonna go / going to go: only "go" is shared
    want = 1 / (math.sqrt(1 + idf**2) * math.sqrt(1 + 2 * idf**2))
    assert abs(rows[12]["tfidf_cosine"] - want) < 1e-12
    assert abs(rows[10]["tfidf_cosine"] - 1) < 1e-12 and rows[3]["tfidf_cosine"] == 0


def test_all_features_is_one_map_stage(edge_pairs):
    df = fe.pair_features(cleaned(edge_pairs))
    assert df.columns == ["id", *Q, *fe.FEATURES]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1
    assert df.count() == 12


def test_long_repetitive_text(spark):
    text = " ".join(f"w{i % 700}" for i in range(6000))
    df = spark.createDataFrame([(1, text, text + " tail")], "id long, question1 string, question2 string")
    r = fe.with_ngrams(fe.with_distances(df, *Q), *Q, 2, "n").first()
    assert r["n"] == 5999 and r["cityblock_distance"] > 0


def test_pair_kernels_match_brute_force(spark, monkeypatch):
    """Pairs of a batch are sorted at once, in chunks; no lambda runs over a vector."""
    import random

    rnd = random.Random(7)
    words = ["a", "b", "ab", "é", "日本", "𝄞", "ﬀ", *[f"w{k}" for k in range(9)]]
    texts = [[[rnd.choice(words) for _ in range(rnd.choice([0, 1, 2, 5, 40]))] for _ in Q] for _ in range(60)]
    rows = [(k, *map(" ".join, pair)) for k, pair in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, question1 string, question2 string").coalesce(1)
    monkeypatch.setattr(bags, "_CHUNK_WORDS", 30)
    full = fe.with_ngrams(fe.with_ngrams(fe.with_distances(fe.with_vectors(df, *Q), *Q), *Q, 2, "n2"), *Q, 3, "n3")
    assert "lambda" not in full._jdf.queryExecution().toString()
    rows = by_id(full)
    for k, (a, b) in enumerate(texts):
        vocab = sorted({*a, *b}, key=lambda w: w.encode())
        u, v = ([0] * len(y) + sorted(vocab.index(w) + 1 for w in x) for x, y in ((a, b), (b, a)))
        assert (rows[k]["vec1"], rows[k]["vec2"]) == (u, v)
        assert rows[k]["cityblock_distance"] == sum(abs(x - y) for x, y in zip(u, v))
        assert rows[k]["euclidean_distance"] == math.sqrt(sum((x - y) ** 2 for x, y in zip(u, v)))
        assert abs(rows[k]["canberra_distance"] - sum(abs(x - y) / (x + y) for x, y in zip(u, v) if x + y)) < 1e-9
        for n in (2, 3):
            grams = [[tuple(x[i : i + n]) for i in range(len(x) - n + 1)] for x in (a, b)]
            assert rows[k][f"n{n}"] == sum(g in grams[1] for g in grams[0])


def test_tfidf_cosine_of_pairs_against_brute_force(spark):
    """Words by a kernel in Python, no lambda for each word: with every word and with the most frequent ones."""
    import numpy as np

    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(12)]
    texts = [(i, *(" ".join(rng.choice(words, rng.integers(0, 15))) for _ in range(2))) for i in range(60)] + [(60, None, "w1"), (61, "w1", None)]
    df = spark.createDataFrame(texts, "id long, question1 string, question2 string")
    for most in (None, 4):
        out = fe.with_tfidf_cosine(df, "question1", "question2", most)
        assert "ArrowEvalPython" in out._jdf.queryExecution().optimizedPlan().toString()
        got = {r.id: r.tfidf_cosine for r in out.collect()}
        assert got[60] is None and got[61] is None
        for i, a, b in texts[:60]:
            a, b = a.split(), b.split()
            vocab = sorted(set(a + b), key=lambda w: (-(a + b).count(w), w))[:most]
            u, v = (np.array([t.count(w) * (1.0 if w in a and w in b else 1 + np.log(1.5)) for w in vocab]) for t in (a, b))
            norm = np.sqrt((u * u).sum()) * np.sqrt((v * v).sum())
            assert abs(got[i] - (u @ v / norm if norm else 0)) < 1e-12
