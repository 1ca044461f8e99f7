import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from twinscope.functions import fuzzy


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def slow_ratio(a, b):
    if a == b:
        return 100
    if not a or not b:
        return 0
    return int(round(100 * (2 * slow_lcs(a, b) / (len(a) + len(b)))))


def slow_partial(a, b):
    s, t = sorted((a, b), key=len)
    if a == b:
        return 100
    if not s:
        return 0
    return max(slow_ratio(s, t[i:i + len(s)]) for i in range(len(t) - len(s) + 1))


ALPHABET = st.text(alphabet="ab cé𝄞", max_size=24)


@settings(max_examples=300, deadline=None)
@given(ALPHABET, ALPHABET)
def test_ratio_against_brute_force(a, b):
    assert fuzzy.lcs_length(a, b) == slow_lcs(a, b)
    assert fuzzy.ratio(a, b) == slow_ratio(a, b)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(ALPHABET, ALPHABET), max_size=12))
def test_partial_ratio_against_all_windows(pairs):
    got = fuzzy.partial_ratios(pairs)
    assert got == {p: slow_partial(*p) for p in pairs}


def test_partial_ratio_mixed_lengths_in_one_batch():
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdef ") for _ in range(n))
    pairs = [(word(rng.randint(1, 60)), word(rng.randint(1, 200))) for _ in range(60)]
    ratios = {}
    assert fuzzy.partial_ratios(pairs, ratios) == {p: slow_partial(*p) for p in pairs}
    assert len(ratios) > 30 and all(r == slow_ratio(*p) for p, r in ratios.items())


def slow_process(s):
    ascii_only = "".join(c for c in s if ord(c) < 128)
    return "".join(c if c.isalnum() or c == "_" else " " for c in ascii_only).lower().strip()


def slow_scores(q1, q2):
    p1, p2 = slow_process(q1), slow_process(q2)
    valid = bool(p1 and p2)
    s1, s2 = (" ".join(sorted(p.split())) for p in (p1, p2))
    t1, t2 = set(p1.split()), set(p2.split())
    sect = " ".join(sorted(t1 & t2))
    c1 = (sect + " " + " ".join(sorted(t1 - t2))).strip()
    c2 = (sect + " " + " ".join(sorted(t2 - t1))).strip()
    trio = [(sect, c1), (sect, c2), (c1, c2)]
    out = {
        "fuzz_qratio": slow_ratio(p1, p2) if valid else 0,
        "fuzz_partial_ratio": slow_partial(q1, q2),
        "fuzz_token_sort_ratio": slow_ratio(s1, s2),
        "fuzz_partial_token_sort_ratio": slow_partial(s1, s2),
        "fuzz_token_set_ratio": max(slow_ratio(*x) for x in trio) if valid else 0,
        "fuzz_partial_token_set_ratio": max(slow_partial(*x) for x in trio) if valid else 0,
    }
    weighted = 0
    if valid:
        span = max(len(p1), len(p2)) / min(len(p1), len(p2))
        if span < 1.5:
            best = max(out["fuzz_qratio"], out["fuzz_token_sort_ratio"] * 0.95, out["fuzz_token_set_ratio"] * 0.95)
        else:
            scale = 0.6 if span > 8 else 0.9
            best = max(
                out["fuzz_qratio"],
                slow_partial(p1, p2) * scale,
                out["fuzz_partial_token_sort_ratio"] * 0.95 * scale,
                out["fuzz_partial_token_set_ratio"] * 0.95 * scale,
            )
        weighted = int(round(best))
    return out | {"fuzz_WRatio": weighted}


def test_all_scores_against_plain_python(spark, edge_pairs):
    rng = random.Random(3)
    phrase = lambda n: " ".join(rng.choice(["is", "the", "fuzzy", "Bear", "bears", "a-b", "été", "x_y"]) for _ in range(n))
    extra = [(100 + i, phrase(rng.randint(0, 6)), phrase(rng.randint(0, 20))) for i in range(60)]
    df = edge_pairs.na.drop().unionByName(spark.createDataFrame(extra, edge_pairs.schema))
    rows = fuzzy.with_fuzzy_scores(df, "question1", "question2").collect()
    assert len(rows) == df.count()
    for r in rows:
        want = slow_scores(r["question1"], r["question2"])
        assert {n: r[n] for n in fuzzy.SCORES} == want, r


def test_edge_scores(edge_pairs):
    rows = {r["id"]: r for r in fuzzy.with_fuzzy_scores(edge_pairs.na.drop(), "question1", "question2").collect()}
    assert rows[2]["fuzz_qratio"] == 0 and rows[2]["fuzz_partial_ratio"] == 100
    assert rows[4]["fuzz_qratio"] == rows[4]["fuzz_WRatio"] == 100
    assert rows[6]["fuzz_token_sort_ratio"] == 100 and rows[6]["fuzz_qratio"] < 100


def test_scores_are_symmetric(edge_pairs):
    df = edge_pairs.na.drop()
    names = [F.col(n) for n in fuzzy.SCORES]
    one = fuzzy.with_fuzzy_scores(df, "question1", "question2").select("id", *names)
    two = fuzzy.with_fuzzy_scores(df, "question2", "question1").select("id", *names)
    assert one.exceptAll(two).count() == 0


def test_bounded_windows_give_the_same_with_fewer_cells(monkeypatch):
    rng = random.Random(11)
    letters = "etaoinshr dlu"

    def text(n):
        return "".join(rng.choice(letters) for _ in range(n))

    body = text(900)
    pairs = [(text(60), text(400)), ("abc" * 20, "xyz" * 60), (body[300:420], body), (body[300:420].replace("e", "q", 3), body), ("漢字" * 30, text(300) + "漢x字" * 20)]
    want = fuzzy.partial_ratios(pairs)
    cells = {}
    for s, t in pairs:
        reached, ranges = fuzzy.candidate_windows(s, t)
        best = max(fuzzy.lcs_length(s, t[i : i + len(s)]) for i in range(len(t) - len(s) + 1))
        # Windows outside the ranges don't beat what was reached.
        inside = [fuzzy.lcs_length(s, t[i : i + len(s)]) for a, b in ranges for i in range(a, b + 1)]
        assert max([reached, *inside]) == best
        cells[s] = sum((b - a + len(s)) * len(s) for a, b in ranges)
    assert cells["abc" * 20] == 0
    assert cells[pairs[3][0]] < 0.5 * len(pairs[3][0]) * len(body)
    monkeypatch.setattr(fuzzy, "_BOUND_CELLS", 0)
    assert fuzzy.partial_ratios(pairs) == want


def test_one_score_alone_is_the_same(edge_pairs):
    whole = {r.id: r for r in fuzzy.with_fuzzy_scores(edge_pairs.na.fill(""), "question1", "question2").collect()}
    for name in fuzzy.SCORES:
        alone = fuzzy.with_fuzzy_scores(edge_pairs.na.fill(""), "question1", "question2", [name])
        assert {r.id: r[name] for r in alone.collect()} == {i: r[name] for i, r in whole.items()}


def test_full_process_keeps_ascii_letters_digits_and_underscores(spark):
    """Every ASCII character and some others, alone and between words; and no negated list of ranges."""
    texts = [f"{c}a{c}B_9{c}{c}z{c}" for c in [*map(chr, range(1, 128)), "é", "ß", "٣", " ", "\U0001f600", "İ"]]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = {r.t: r.p for r in df.select("t", fuzzy.full_process(F.col("t")).alias("p")).collect()}
    for t in texts:
        kept = "".join(ch if ch.isalnum() or ch == "_" else " " for ch in t if ord(ch) < 128)
        assert got[t] == kept.lower().strip(" ")
    assert "A-Z" not in str(fuzzy.full_process(F.col("t")))
