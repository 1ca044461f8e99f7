"""The registered queries against SQL, or against brute force where SQL has no form, at the smallest scale."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from twinscope.llm import linededup, neardup, oracle, packing, queries, substrings

SF = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def docs(duck):
    return [(i, t or "") for i, t in duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()]


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    cursor = duck.execute(oracle.SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()), key=repr)


def test_toxicity(spark, duck, docs):
    rows = {r.doc_id: r for r in queries.op1_toxicity(spark, "/root/testdata/sf0.01").collect()}
    labels = duck.execute("SELECT doc_id, toxic FROM '/root/testdata/sf0.01/labels.parquet' WHERE toxic IS NOT NULL").fetchall()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows.values())
    held = [(rows[i].score, y) for i, y in labels if rows[i].held_out]
    toxic, clean = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([(s > c) + 0.5 * (s == c) for s in toxic for c in clean])
    assert auc > 0.9
    assert np.mean([s >= 0.7 for s in clean]) < 0.03


def test_line_dedup_without_a_map(spark, duck, monkeypatch):
    """With more keys than a map has room for, rows are the same."""
    monkeypatch.setattr(linededup, "MOST_BITS", 0)
    test_query_equals_sql(spark, duck, "op6_line_dedup")


def test_sharding(spark, docs):
    rows = queries.op3_sharding(spark, SF).collect()
    want = {i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in docs}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == want
    shards = defaultdict(list)
    for r in rows:
        shards[r.shard].append(r.slot)
    assert sorted(shards) == list(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    # A shuffle: places say nothing about ids.
    ids = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert abs(np.corrcoef(ids, range(len(ids)))[0, 1]) < 0.3


def near_components(docs, width, percent):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets, by_shingle, least = {}, defaultdict(list), {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate(lower))
        sets[i] = {tuple(w)} if 0 < len(w) < width else {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}
        least[i] = i

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for i, s in sets.items():
        shared = Counter()
        for g in s:
            shared.update(by_shingle[g])
            by_shingle[g].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                least[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("members", [2048, 2])
def test_near_duplicates(spark, docs, members, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", members)
    rows = queries.op5_near_duplicates(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == near_components(docs, 3, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_packing(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in docs}
    rows = queries.op7_packing(spark, SF).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
        piece = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert zlib.crc32(piece.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
    for parts, total in [*((pieces[i], len(x)) for i, x in ids.items()), *((s, None) for s in sequences.values())]:
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == total if total is not None else at <= 2048
    assert sum(sum(n for _, n in s) < 2048 for s in sequences.values()) <= 1


def removed_bytes(texts, length):
    seen = Counter(b[s : s + length] for b in texts for s in range(len(b) - length + 1))
    out = []
    for b in texts:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        out.append(gone)
    return out


@pytest.mark.parametrize(("places", "hot"), [(2000, 1000), (3, 1000), (3, 2)])
def test_substring_dedup(spark, docs, places, hot, monkeypatch):
    monkeypatch.setattr(substrings, "GROUP_PLACES", places)
    monkeypatch.setattr(substrings, "HOT_ANCHORS", hot)
    texts = [t.encode() for _, t in docs]
    want = {}
    for (i, _), b, gone in zip(docs, texts, removed_bytes(texts, 400), strict=True):
        spans = len(re.findall(b"\1+", bytes(gone)))
        want[i] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    rows = queries.op8_substring_dedup(spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want


def test_words_make_the_same_ids():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = packing._Encoder(*packing.vocabulary_of(None))
    for text in ["", " ", "  ", "a  b", "a \nb", " a", "a ", "\n a  \n  b <|endoftext|> x", "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>  <|endoftext|>\n", " <|endoftext |>", "it's we'll  're", "　 x \t y", "é 漢字 🙂 ", "a\n\n b"]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
