"""Benchmark decontamination by Wu-Manber multi-pattern search over words."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Collection, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinscope.llm.components import written
from twinscope.llm.textbytes import ALPHANUMERIC, slices

#: Bytes to words: A-Z lower-cased, all that is no letter, digit or byte above 127 a space.
WORD_BYTES = bytes(b or 32 for b in ALPHANUMERIC.tolist())
#: Windows in one set of tables, one per item that holds it; more are searched in further passes over the same rows.
WINDOWS_PER_PASS = 500_000

def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


def windows_of(words: list[bytes], width: int) -> Iterator[tuple[bytes, ...]]:
    """All runs of ``width`` words; a shorter text is one window, one without words none."""
    if words:
        for i in range(max(1, len(words) - width + 1)):
            yield tuple(words[i : i + width])


def tables_of(patterns: dict[tuple[bytes, ...], Collection[str]]) -> list[tuple]:
    """Wu-Manber tables by pattern length, as skips depend on the shortest pattern.

    A block is two words (one for patterns of one word). ``shift`` tells how far a window can
    move when it ends in a block; blocks that no pattern holds allow the largest move.
    ``bucket`` holds, for blocks that end a pattern, the patterns by their first word.
    """
    by_length = defaultdict(list)
    for p in patterns:
        by_length[len(p)].append(p)
    tables = []
    for m, group in sorted(by_length.items()):
        b = min(2, m)
        shift: dict[bytes, int] = {}
        bucket: dict[bytes, dict[bytes, list]] = defaultdict(lambda: defaultdict(list))
        for p in group:
            for end in range(b, m + 1):
                block = b" ".join(p[end - b : end])
                shift[block] = min(shift.get(block, m), m - end)
            bucket[block][p[0]].append((p, patterns[p]))
        tables.append((m, b, shift, {k: dict(v) for k, v in bucket.items()}))
    return tables


def search(words: list[bytes], tables: list[tuple], hit: bytearray, items: set[str]) -> None:
    """Mark the words of all occurrences in ``hit`` and collect the patterns' items."""
    n = len(words)
    for m, b, shift, bucket in tables:
        most = m - b + 1
        end = m
        while end <= n:
            block = words[end - 1] if b == 1 else words[end - 2] + b" " + words[end - 1]
            step = shift.get(block, most)
            if step:
                end += step
                continue
            window = tuple(words[end - m : end])
            for pattern, owners in bucket[block].get(window[0], ()):
                if pattern == window:
                    hit[end - m : end] = b"\1" * m
                    items.update(owners)
            end += 1


def _search_pass(tables, text: str, columns: list[str]):
    """A pass over the rows: adds to what earlier passes found."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 8 << 20):
            marks, owners, counts = [], [], []
            for value, before, had in zip(batch.column(text).to_pylist(), batch.column("_hit").to_pylist(), batch.column("_items").to_pylist(), strict=True):
                words = words_of(value)
                hit, items = bytearray(before or bytes(len(words))), set(had or ())
                search(words, tables.value, hit, items)
                marks.append(bytes(hit))
                owners.append(sorted(items))
                counts.append(hit.count(1))
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(marks, pa.binary()), pa.array(owners, pa.list_(pa.string())), pa.array(counts, pa.int64())], [*columns, "_hit", "_items", "n_hit"])

    return scan


def find_contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, text: str = "text", item: str = "item_id", per_pass: int = WINDOWS_PER_PASS) -> DataFrame:
    """Rows of ``docs`` with ``n_words``, ``n_hit`` (words inside an occurrence of a window of
    ``width`` item words), ``items`` (sorted ids of the items with occurring windows).

    The benchmark is the stated query set: its windows, each once per item id that holds it,
    are searched ``per_pass`` at a time and what a pass found is written before the next, so the
    driver and a task hold the tables of one pass; every pass sees all rows. Documents are not
    shuffled. A null or empty text has no words; items without words never occur; a null item
    id counts as the empty string; repeated items count once by id. Columns of ``docs`` named
    like the added ones are replaced; names that begin with an underscore are reserved.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_words", "n_hit", "items")
    columns = docs.columns
    found = docs.withColumns({"_hit": F.lit(None).cast("binary"), "_items": F.array().cast("array<string>"), "n_hit": F.lit(0).cast("long")})

    def searched(found: DataFrame, patterns: dict) -> DataFrame:
        tables = spark.sparkContext.broadcast(tables_of(patterns))
        return found.mapInArrow(_search_pass(tables, text, columns), found.schema)

    patterns: dict[tuple[bytes, ...], set[str]] = {}
    entries = 0
    for row in benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).toLocalIterator():
        for window in windows_of(words_of(row.t), width):
            owners = patterns.setdefault(window, set())
            if (row.i or "") in owners:
                continue
            owners.add(row.i or "")
            entries += 1
            if entries >= per_pass:
                found = written(searched(found, patterns), "pass")
                patterns, entries = {}, 0
    found = searched(found, patterns)
    return found.select(*columns, F.octet_length("_hit").cast("long").alias("n_words"), "n_hit", F.col("_items").alias("items"))
