"""Every stage of the pipeline against brute force on what its predecessor kept."""

import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from twinscope.llm.decontaminate import words_of
from twinscope.llm.packing import _Encoder, vocabulary_of
from twinscope.llm.toxicity import score_toxicity, train

from .test_queries import near_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and gave."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.DOCUMENTS)
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "rows")
        stage(spark, docs, SF).write.parquet(path)
        result = spark.read.parquet(path)
        out[name] = (docs.collect(), result.collect())
        if name != "packing":
            assert result.columns == corpus_pipeline.DOCUMENTS
        docs = result
    return out


def test_toxicity(spark, stages):
    given, kept = stages["toxicity"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scored = score_toxicity(docs, train(docs.select("doc_id", "text", "lang"), spark.read.parquet(f"{SF}/labels.parquet")))
    assert {r.doc_id for r in kept} == {r.doc_id for r in scored.where("not rejected").collect()}
    assert 0.7 * len(given) < len(kept) <= len(given)


def without_repeats(rows):
    """Lines that an earlier one equals or is one word edit from (from ten words)."""
    lines = []
    for r in sorted(rows, key=lambda r: r.doc_id):
        for i, raw in enumerate((r.text or "").split("\n")):
            lines.append((r.doc_id, i, raw, re.sub(r"\s+", " ", raw.lower()).strip().split(" ")))
    seen, gaps, kept = set(), set(), defaultdict(list)
    for doc, _, raw, w in lines:
        near = set()
        if len(w) >= 10:
            near = {(*w[:k], "*", *w[k + 1 :]) for k in range(len(w))} | {(*w[:k], "*", *w[k:]) for k in range(len(w) + 1)}
        if not (w != [""] and (tuple(w) in seen or near & gaps)):
            kept[doc].append(raw)
        seen.add(tuple(w))
        gaps |= near
    return kept


def test_line_dedup(stages):
    given, kept = stages["line dedup"]
    want = without_repeats(given)
    texts = {r.doc_id: "\n".join(want[r.doc_id]) for r in given}
    empty = {r.doc_id for r in given if texts[r.doc_id] != r.text and not texts[r.doc_id].strip()}
    assert {r.doc_id: r.text for r in kept} == {i: t for i, t in texts.items() if i not in empty}
    changed = {r.doc_id: r.text for r in given if r.text != texts[r.doc_id]}
    assert changed and all(r.n_chars == len(r.text) for r in kept if r.doc_id in changed)


def test_near_dedup(stages):
    given, kept = stages["MinHash near-dedup"]
    want = near_components([(r.doc_id, r.text or "") for r in given], 5, 80)
    assert {r.doc_id for r in kept} == {i for i, (_, least) in want.items() if i == least}


def test_decontamination(stages):
    given, kept = stages["benchmark decontamination"]
    windows = set()
    for (text,) in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall():
        w = words_of(text)
        windows |= {b" ".join(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    hit = {r.doc_id for r in given if any(b" %s " % p in b" %s " % b" ".join(words_of(r.text)) for p in windows)}
    assert {r.doc_id for r in kept} == {r.doc_id for r in given} - hit


def test_packing(stages):
    given, pieces = stages["packing"]
    encoder, got = _Encoder(*vocabulary_of(None)), defaultdict(list)
    for r in sorted(pieces, key=lambda r: r.start):
        got[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
    assert got == {r.doc_id: [*np.frombuffer(encoder.encode(r.text or ""), "<u4").tolist(), 1] for r in given}


def test_stages_take_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            out.collect()
            assert name == "packing" or out.columns == docs.columns
