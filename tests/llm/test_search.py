"""Ranked lexical search: ball trees against brute force, bounds, ties and edges."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from twinscope.llm import balltree

from .conftest import rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute_force(docs, items, top):
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in counted:
            n = sum(c.values())
            m = 75 + (25 * n * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c
            )
            if score > 0:
                found.append((-score, i is not None, i or 0))
        out += [(item, rank, i if known else None, -s) for rank, (s, known, i) in enumerate(sorted(found)[:top], 1)]
    return Counter(out)


ITEMS = [(1, "alpha BETA gamma words words"), (None, "漢字 again text"), (2, ""), (3, None), (4, "nowhere"), (5, "words"), (5, "words")]


@pytest.mark.parametrize("block", [2000, 2])
def test_against_brute_force(spark, odd_docs, block):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = rows_of(balltree.search(odd_docs, items, top=3, items_per_pass=block))
    docs = [(r["doc_id"], r["text"]) for r in rows_of(odd_docs)]
    assert Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got) == brute_force(docs, ITEMS, 3)


def test_empty_tables_and_names(spark, odd_docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rows_of(balltree.search(no_docs, items)) == []
    assert rows_of(balltree.search(odd_docs, items.limit(0))) == []
    clash = odd_docs.selectExpr("*", "'x' AS rank", "'x' AS score", "'x' AS item", "'x' AS _n")
    assert len(rows_of(balltree.search(clash, items))) == len(rows_of(balltree.search(odd_docs, items)))


def test_pruned_search_is_exact_and_scores_fewer_leaves(spark):
    # Texts of two vocabularies: an item of one needs no leaf of the other.
    rng = np.random.default_rng(3)
    docs = [(k, " ".join(f"{'ab'[k % 2]}{w}" for w in rng.zipf(1.5, 30) % 300)) for k in range(3000)]
    items = [(k, " ".join(f"{'ab'[k % 2]}{w}" for w in rng.integers(0, 60, 5))) for k in range(12)]
    found = balltree.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(2), spark.createDataFrame(items, "item_id long, text string"), with_work=True)
    rows = rows_of(found)
    assert Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows) == brute_force(docs, items, 20)
    assert all(r["leaves"] < 0.8 * r["all_leaves"] for r in rows)


def test_bounds_hold():
    rng = np.random.default_rng(5)
    points = np.where(rng.random((700, 90)) < 0.1, rng.integers(1, 1_000_000, (700, 90)), 0).astype(np.float32)
    tree = balltree.Ball(points, leaf=8)
    assert sorted(tree.order) == list(range(700))
    for _ in range(50):
        at = np.sort(rng.choice(90, 7, replace=False))
        values = rng.integers(1, 40_000, 7).astype(float)
        bounds = tree.bounds(at, values)
        exact = points[:, at].astype(np.int64) @ values.astype(np.int64)
        assert all(exact[tree.lo[k] : tree.hi[k]].max() <= bounds[k] for k in range(len(bounds)))


def test_large_sums_stay_exact():
    points = np.full((3, 2), 999_999, np.float32)
    n = np.array([10, 10, 10])
    tf = np.array([1, 5, 2**31])
    got = balltree.impacts(tf, n, 100, 1000)
    assert got.tolist() == [(10**9 * int(t)) // (1000 * int(t) + 12 * (75 + 25)) for t in tf]
    tree = balltree.Ball(points)
    kept = []
    balltree.best_first(tree, tree.bounds(np.array([0, 1]), np.array([2.0**33, 1.0])), lambda a, b: points[a:b].astype(np.int64) @ np.array([2**33, 1]), lambda r: (r, r), kept, 2)
    assert sorted(e[0] for e in kept) == [999_999 * (2**33 + 1)] * 2 and {e[2] for e in kept} == {0, 1}
