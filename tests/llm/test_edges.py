"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinscope.llm import chat, components, decontaminate, fingerprint, linededup, neardup, packing, reputation, sharding, substrings, toxicity

from .conftest import rows_of


@pytest.fixture(scope="module")
def clash(odd_docs):
    """Columns named like those that operators add."""
    names = "shard slot n_words n_hit items start length ids doc_tokens sequence_id offset n_shingles component_id kept n_lines n_dropped n_removed n_spans score threshold rejected tree".split()
    return odd_docs.withColumns({n: F.lit("x") for n in names})


def same_ids(df, docs):
    assert Counter(r["doc_id"] for r in rows_of(df)) == Counter(r["doc_id"] for r in rows_of(docs))


def test_shuffle(odd_docs, clash, no_docs):
    for docs in (odd_docs, clash):
        out = rows_of(sharding.external_shuffle(docs, 5, bucket_bytes=5000))
        assert Counter((r["doc_id"], r["text"]) for r in out) == Counter((r["doc_id"], r["text"]) for r in rows_of(odd_docs))
        sizes = Counter(r["shard"] for r in out)
        assert len(out) == 12 and max(sizes.values()) - min(sizes.values()) <= 1
        assert all(sorted(r["slot"] for r in out if r["shard"] == s) == list(range(n)) for s, n in sizes.items())
    again = rows_of(sharding.external_shuffle(odd_docs, 5, bucket_bytes=5000))
    key = lambda r: (r["shard"], r["slot"])
    assert [r["text"] for r in sorted(again, key=key)] == [r["text"] for r in sorted(out, key=key)]
    assert rows_of(sharding.external_shuffle(no_docs, 5)) == []


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(sharding.fisher_yates(3, np.random.default_rng(k))) for k in range(6000))
    assert len(seen) == 6 and min(seen.values()) > 850


def test_write_shards(spark, odd_docs, tmp_path):
    sharding.write_shards(sharding.external_shuffle(odd_docs, 3), str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).groupBy("shard").count().collect()


def test_decontamination(spark, odd_docs, clash, no_docs):
    items = spark.createDataFrame(
        [(1, "beta GAMMA, delta epsilon zeta eta theta iota kappa lambda"), (None, "one"), (2, ""), (3, None), (10, "one"), (10, "one")], "item_id long, text string"
    )
    for docs in (odd_docs, clash):
        out = rows_of(decontaminate.find_contamination(docs, items))
        assert len(out) == 12
        by_text = {r["text"]: (r["n_words"], r["n_hit"], r["items"]) for r in out}
        assert by_text["one"] == (1, 1, ["", "10"])
        assert by_text[None] == by_text[""] == (0, 0, [])
        assert by_text["alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"] == (11, 10, ["1"])
    # Windows in several passes give the same.
    several = decontaminate.find_contamination(odd_docs, items, per_pass=1)
    assert sorted(map(str, rows_of(several))) == sorted(map(str, rows_of(decontaminate.find_contamination(odd_docs, items))))
    assert rows_of(decontaminate.find_contamination(no_docs, items)) == []
    assert all(r["n_hit"] == 0 for r in rows_of(decontaminate.find_contamination(odd_docs, items.limit(0))))


def test_decontamination_bounds_the_owners(spark, odd_docs, monkeypatch):
    """Copies of an item count towards a pass, repeated ids once."""
    item = "beta gamma delta epsilon zeta eta theta iota kappa lambda"
    items = spark.createDataFrame([(k // 2, item) for k in range(60)], "item_id long, text string")
    whole = rows_of(decontaminate.find_contamination(odd_docs, items))
    sent, tables_of = [], decontaminate.tables_of
    monkeypatch.setattr(decontaminate, "tables_of", lambda p: sent.append(sum(map(len, p.values()))) or tables_of(p))
    several = rows_of(decontaminate.find_contamination(odd_docs, items, per_pass=20))
    # A repeated id at the cut stands in both passes.
    assert max(sent) <= 20 and sum(sent) in (30, 31)
    assert sorted(map(str, several)) == sorted(map(str, whole)) and max(len(r["items"]) for r in whole) == 30


def test_wu_manber_finds_all():
    rng = random.Random(1)
    for _ in range(200):
        words = [bytes([97 + rng.randrange(3)]) for _ in range(60)]
        patterns = {tuple(bytes([97 + rng.randrange(3)]) for _ in range(rng.randint(1, 5))): [str(k)] for k in range(6)}
        hit, items = bytearray(60), set()
        decontaminate.search(words, decontaminate.tables_of(patterns), hit, items)
        want, owners = bytearray(60), set()
        for p, (owner,) in patterns.items():
            for s in range(60 - len(p) + 1):
                if tuple(words[s : s + len(p)]) == p:
                    want[s : s + len(p)] = b"\1" * len(p)
                    owners.add(owner)
        assert (hit, items) == (want, owners)


def test_near_duplicates(spark, odd_docs, clash, no_docs):
    for docs in (odd_docs, clash):
        out = rows_of(neardup.near_duplicates(docs, width=3, percent=85))
        same_ids(spark.createDataFrame([(r["doc_id"],) for r in out], "doc_id long"), odd_docs)
        got = {(r["doc_id"], r["text"]): (r["component_id"], r["kept"]) for r in out}
        assert {v for k, v in got.items() if k[0] is None} == {(None, True)}
        assert got[(1, None)] == (1, True) and got[(2, "")] == (2, True)
        assert {k[0]: v for k, v in got.items() if k[0] in (4, 5)} == {4: (4, True), 5: (4, False)}
        # Rows that share an id are one node.
        assert {v for k, v in got.items() if k[0] == 7} == {(6, False)}
    assert rows_of(neardup.near_duplicates(no_docs)) == []


def test_near_duplicates_in_a_hot_group(spark, monkeypatch):
    """A third of the rows nearly equal, in chains that only blocks resolve."""
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 7)
    monkeypatch.setattr(neardup, "CHUNK_BYTES", 2000)
    rng = random.Random(3)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(60)] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(f"y{rng.randrange(5000)}" for _ in range(60))) for i in range(120)]
    from .test_queries import near_components

    out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=3, percent=85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == near_components(rows, 3, 85)


def test_components(spark):
    links = spark.createDataFrame([(k + 1, k) for k in range(30)] + [(41, 40), (42, 40), (50, 50)], "a long, b long")
    got = {r.node: r.component for r in components.connected_components(links).collect()}
    assert got == {**{k: 0 for k in range(31)}, 40: 40, 41: 40, 42: 40}
    assert components.connected_components(links.limit(0)).collect() == []


def test_line_dedup(odd_docs, clash, no_docs):
    for docs in (odd_docs, clash):
        out = rows_of(linededup.dedup_lines(docs, min_words=5, min_edit_words=10))
        got = {(r["doc_id"], r["n_lines"]): (r["text"], r["n_dropped"]) for r in out}
        assert len(out) == 12
        assert got[(1, 0)] == (None, 0) and got[(2, 1)] == ("", 0)
        assert got[(5, 1)] == ("", 1) and got[(4, 1)][1] == 0
        # One word differs from the line of document 6.
        assert got[(7, 4)] == ("\n  \nÄÖÜ ß 漢字 🙂", 1)
    assert rows_of(linededup.dedup_lines(no_docs)) == []


def test_line_edits(spark):
    line = "a b c d e f g h i j k l"
    texts = [line, line.replace("d", "x"), line.replace("d ", ""), "z " + line, line + " z", line.replace("d", "x").replace("k", "y"), "b a" + line[3:]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    gone = [r.n_dropped for r in linededup.dedup_lines(docs).orderBy("doc_id").collect()]
    # The sixth is one edit from the second; the last is two from all others.
    assert gone == [0, 1, 1, 1, 1, 1, 0]


def test_toxicity_of_a_text_alone_and_before_others():
    rng = np.random.default_rng(1)
    net = toxicity.Net(
        rng.normal(0, 1, (toxicity.BUCKETS + 1, toxicity.DIM)),
        [rng.normal(0, 1, (w, toxicity.DIM, toxicity.FILTERS)) for w in toxicity.WIDTHS],
        rng.normal(0, 1, len(toxicity.WIDTHS) * toxicity.FILTERS),
        rng.normal(0, 1, len(toxicity.WIDTHS) * toxicity.FILTERS),
    )
    net.embedding[toxicity.PAD] = 0

    def logits(texts):
        parts = [np.frombuffer(t.encode(), np.uint8) for t in texts]
        return net.logits(*toxicity.word_ids(np.concatenate(parts), np.cumsum([0, *map(len, parts)])))

    texts = ["", "one", "a b", "", "some words of a longer text", "one", "x y z", ""]
    alone = [float(logits([t])[0]) for t in texts]
    assert np.allclose(logits(texts), alone) and np.allclose(logits(texts[::-1]), alone[::-1])


def test_packing(odd_docs, clash, no_docs):
    for docs in (odd_docs, clash):
        pieces = rows_of(packing.pack(docs, length=64))
        assert sum(r["length"] for r in pieces if r["start"] == 0 and r["doc_tokens"] == 1) == 3
        by_sequence = Counter()
        for r in pieces:
            assert len(r["ids"]) == 4 * r["length"]
            by_sequence[r["sequence_id"]] += r["length"]
        assert all(n == 64 for s, n in by_sequence.items() if s < max(by_sequence))
    whole = rows_of(packing.sequences(packing.pack(odd_docs, length=64), 64))
    assert all(len(r["ids"]) == 256 and r["boundaries"][0]["offset"] == 0 for r in whole)
    assert rows_of(packing.pack(no_docs)) == []


def test_substrings(spark, odd_docs, clash, no_docs):
    from .test_queries import removed_bytes

    for docs in (odd_docs, clash):
        out = [r for r in rows_of(substrings.remove_repeats(docs, length=40))]
        texts = [(r["text"] or "").encode() for r in out]
        want = removed_bytes(texts, 40)
        assert [(r["n_removed"], bytes(r["kept"])) for r in out] == [
            (sum(g), bytes(x for x, gone in zip(t, g, strict=True) if not gone)) for t, g in zip(texts, want, strict=True)
        ]
    assert rows_of(substrings.remove_repeats(no_docs)) == []
    # Periodic texts, and windows that meet in every way.
    rng = random.Random(5)
    blocks = ["ab" * 30, "a" * 80, *["".join(rng.choice("abc") for _ in range(50)) for _ in range(4)]]
    rows = [(i, "".join(rng.choice(blocks)[rng.randrange(10) :] for _ in range(rng.randint(1, 4)))) for i in range(60)]
    out = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=40).collect()
    want = removed_bytes([r.text.encode() for r in out], 40)
    assert [r.n_removed for r in out] == [sum(g) for g in want]


def test_merged_transform_is_that_of_all():
    rng = np.random.default_rng(2)
    strings = [rng.integers(1, 4, rng.integers(1, 12)) for _ in range(40)]
    parts = []
    for shard in (strings[:15], strings[15:30], strings[30:]):
        ended = [np.append(s, 0) for s in shard]
        parts.append(substrings.shard_transform(np.concatenate(ended), np.cumsum([0, *map(len, ended)])[:-1])[1])
    shard, common = substrings.merge_transforms(parts)
    suffixes = sorted(tuple(s[k:]) for s in strings for k in range(len(s) + 1))
    same = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    assert common.tolist() == [0, *[same(a, b) for a, b in zip(suffixes[:-1], suffixes[1:], strict=True)]]
    assert np.bincount(shard).tolist() == [len(p) for p in parts]


def test_chat(spark):
    said = "</s>[INST] ok \\ \\[ <<SYS>>\n"
    rows = [(1, 1, "assistant", said), (1, 0, "user", said), (1, 2, "tool [x]", said), (1, 2, "tool [x]", said), (2, 0, None, None), (2, None, "system", ""), (None, 0, "user", "é🙂"), (3, 0, "assistant", "a" * 100_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"piece": F.lit(1), "formatted": F.lit("x"), "loss": F.lit(2)})
    formatted = chat.format_chats(turns)
    texts = {r.conv_id: r.formatted for r in formatted.collect()}
    assert list(chat._turns(texts[1].encode())) == [(r.encode(), said.encode()) for r in ("user", "assistant", "tool [x]", "tool [x]")]
    assert list(chat._turns(texts[2].encode())) == [(b"system", b""), (b"", b"")]
    got = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.read_back(formatted).collect()}
    assert got == {1: (4, len(said)), 2: (2, 0), None: (1, 0), 3: (1, 100_000)}
    assert chat.read_back(chat.format_chats(turns.limit(0))).collect() == []


def test_chat_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(chat, "PIECE_BYTES", 200)
    rows = [(c, t, ("user", "assistant")[t % 2], f"turn <{t}> " * 5) for c in range(4) for t in range(40)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_chats(turns)
    assert formatted.groupBy("conv_id").count().where("count > 5").count() == 4
    assert {(r.n_turns, r.loss_chars) for r in chat.read_back(formatted).collect()} == {(40, sum(len(t) for c, _, r, t in rows if c == 0 and r == "assistant"))}


def test_urls(spark):
    rows = [(1, "HTTP://A.Example.ORG/es/x?y#z"), (2, None), (3, "no scheme"), (4, "https://x.co.uk"), (5, "https://x.co.uk?u=http://b/"), (5, "https://x.co.uk?u=http://b/"), (None, "ftp://h:80/#"), (7, "http://COM/fr/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({n: F.lit("old") for n in ("host", "path", "rule", "verdict")})
    outcomes = spark.createDataFrame([(4, 1), (4, 0), (9, None), (None, 1)], "page_id long, bad int")
    rules = [("block", "example.org/es/"), ("allow", "org/"), ("allow", "com/fr/")]
    out = rows_of(reputation.judge_urls(pages, outcomes, rules))
    got = Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in out)
    assert got == Counter(
        {(1, "a.example.org", "/es/x", "example.org/es/"): 1, (2, "", "", None): 1, (3, "", "", None): 1, (4, "x.co.uk", "", None): 1, (5, "x.co.uk", "", None): 2, (None, "h:80", "/", None): 1, (7, "com", "/fr/", "com/fr/"): 1}
    )
    assert rows_of(reputation.judge_urls(pages.limit(0), outcomes, rules)) == []
    assert len(rows_of(reputation.judge_urls(pages, outcomes.limit(0), rules))) == 8


def test_reputation_shrinks(spark):
    pages = [(i, f"http://{h}.example.com/{i}") for i, h in enumerate(["bad"] * 40 + ["good"] * 200 + ["few"] * 2)]
    outcomes = [(i, int(i < 38 or i >= 240)) for i in range(242)]
    verdicts = reputation.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(outcomes, "page_id long, bad int"), [("allow", "none/")])
    bounds = {r.host.split(".")[0]: (r.bad_bound, r.verdict) for r in verdicts.collect()}
    assert bounds["bad"][1] == "block" and bounds["good"][1] == "allow"
    assert bounds["few"][0] < bounds["bad"][0]


def test_fingerprints(spark, odd_docs, clash, no_docs):
    for docs in (odd_docs, clash):
        out = rows_of(fingerprint.compare_with_next(docs))
        same_ids(spark.createDataFrame([(r["doc_id"],) for r in out], "doc_id long"), odd_docs)
        assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out)
        trees = {r["doc_id"]: r["tree"]["root"] for r in out}
        assert trees[4] == trees[5] and trees[1] == trees[2] != trees[3]
    assert rows_of(fingerprint.compare_with_next(no_docs)) == []
    assert rows_of(fingerprint.fingerprints(clash))[0]["tree"]["root"]


def test_neighbours_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "ROWS_PER_BUCKET", 7)
    ids = [None, None, *random.Random(1).sample(range(1000), 80), 500, 500]
    rows = [(i, f"{k:03d}") for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "id long, v string")
    got = {(r.id, r.v): r.n for r in fingerprint.with_next(df, "id", {"_order": F.col("v"), "n": F.col("v")}).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got == {a: b[1] for a, b in zip(order, order[1:] + order[:1], strict=True)}


def test_edits_are_located(spark):
    body = [f"This is paragraph number {k}." for k in range(30)]
    other = body[:10] + ["An edited one.", "And one more."] + body[11:]
    df = spark.createDataFrame([("\n".join(body), "\n".join(other))], "a string, b string")
    both = fingerprint.with_tree(fingerprint.with_tree(df, "a", "x"), "b", "y")
    row = both.select(fingerprint.edited_paragraphs(F.col("x"), F.col("y")).alias("e"), F.size(F.array_intersect("x.sections", "y.sections")).alias("s")).first()
    assert row.e.asDict() == {"first": 10, "removed": 1, "added": 2} and row.s > 0


def test_toxicity(spark, odd_docs, clash, no_docs):
    rng = random.Random(4)
    words = [f"word{k}" for k in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=40) + (["awful"] if i % 5 == 0 else [])), "en" if i % 2 else None) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)] + [(None, 1), (500, None), (0, 1)], "doc_id long, toxic int")
    net = toxicity.train(docs, labels)
    scored = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, net).collect()}
    assert min(scored[i] for i in range(300, 400, 5)) > max(scored[i] for i in range(300, 400) if i % 5)
    for other in (odd_docs, clash):
        out = rows_of(toxicity.score_toxicity(other, net))
        same_ids(spark.createDataFrame([(r["doc_id"],) for r in out], "doc_id long"), odd_docs)
        assert all(0 <= r["score"] <= 1 for r in out)
    assert rows_of(toxicity.score_toxicity(no_docs, net)) == []
    assert toxicity.train(docs, labels.limit(0)) is None
    assert {r["score"] for r in rows_of(toxicity.score_toxicity(odd_docs, None))} == {0.0}


def test_suffixes_from_a_table(spark):
    hosts = spark.createDataFrame([(h,) for h in ("a.b.co.uk", "co.uk", "x.city.kobe.jp", "www.shop.example.com", "com", "", "1.2.3.4")], "host string")
    suffixes = spark.createDataFrame([("co.uk",), ("com",), ("Kobe.JP",), ("jp",), (None,), ("com",), ("shop.example.com",)], "suffix string")
    got = {r.host: (r.suffix, r.domain) for r in reputation.by_suffix_table(hosts, suffixes).collect()}
    assert got == {
        "a.b.co.uk": ("co.uk", "b.co.uk"), "co.uk": ("co.uk", "co.uk"), "x.city.kobe.jp": ("kobe.jp", "city.kobe.jp"),
        "www.shop.example.com": ("shop.example.com", "www.shop.example.com"), "com": ("com", "com"), "": ("", ""), "1.2.3.4": ("4", "3.4"),
    }
    pages = spark.createDataFrame([(1, "http://a.b.co.uk/x"), (2, None)], "page_id long, url string")
    outcomes = spark.createDataFrame([(1, 1)], "page_id long, bad int")
    assert reputation.judge_urls(pages, outcomes, [("allow", "org/")], suffixes=suffixes).count() == 2
