"""Concatenate and cut: token totals by partition, prefix sums, then fixed windows."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinscope.llm.textbytes import slices
from twinscope.operators.ranking import with_running_totals
from twinscope.sources.scratch import scratch_path

#: Distinct words whose ids a task remembers before it starts afresh.
CACHED_WORDS = 300_000
#: How a byte-level vocabulary of this kind cuts a text before merging.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary_of(path: str | None) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ids of a byte-level vocabulary file by bytes, and of its added tokens by their strings; by
    default the public file with 50k entries.

    In such a file ids follow the order of the merges, so they serve as merge ranks. The file
    writes bytes without a printable form of their own as the characters from 256 on. Added
    tokens that take in spaces around them, or stand for whole words only, are refused.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    model = json.loads(Path(path).read_text(encoding="utf-8"))
    special = {}
    for t in model.get("added_tokens", []):
        if t.get("lstrip") or t.get("rstrip") or t.get("single_word"):
            raise ValueError(f"an added token that is not matched as it stands: {t['content']!r}")
        special[t["content"]] = t["id"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
    return {bytes(byte_of[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}, special


class _Words(dict):
    """Ids of words that follow a space, as little-endian unsigned 32-bit bytes, made when first asked for."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        ids = self[word] = self.encode(" " + word)
        return ids


class _Encoder:
    """Encodes texts as the tokenizer of the file does at its default settings.

    Strings of added tokens are cut out first. The rest goes word by word: no piece of the
    pattern goes on across the place before a single space, so a word with the space before it
    has the same ids in every text."""

    def __init__(self, ranks: dict[bytes, int], special: dict[str, int]):
        import tiktoken

        encoding = tiktoken.Encoding("bytes", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.whole = lambda t: np.array(encoding.encode_ordinary(t), "<u4").tobytes()
        # A space before more white space or the end may belong to a piece of several spaces.
        self.loose = re.compile(r" (?:\s|\Z)").search
        self.words = _Words(self.whole)
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in special.items()}
        # The longest of those that begin at a place, as the library takes them.
        longest = "|".join(map(re.escape, sorted(special, key=len, reverse=True)))
        self.cut = re.compile(f"({longest})") if special else None

    def encode(self, text: str) -> bytes:
        if any(t in text for t in self.special):
            return b"".join(self.special[part] if part in self.special else self._plain(part) for part in self.cut.split(text))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if self.loose(text):
            return self.whole(text)
        head, *rest = text.split(" ")
        return self.whole(head) + b"".join(map(self.words.__getitem__, rest))


def _tokenize(vocabulary, text: str, columns: list[str], end_id: int):
    """Pass 1: each row's ids, and how many ids of its partition come before it."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = _Encoder(*vocabulary.value), 0
        end = np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, text):
            ids = [encoder.encode(t or "") + end for t in batch.column(text).to_pylist()]
            n = np.array([len(b) // 4 for b in ids], np.int64)
            at = before + np.cumsum(n) - n
            before += int(n.sum())
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(ids, pa.binary()), pa.array(n), pa.array(at)], [*columns, "_ids", "_n", "_at"])

    return tokenize


def pack(docs: DataFrame, length: int = 2048, text: str = "text", end_id: int = 1, vocabulary: str | None = None) -> DataFrame:
    """All documents' ids in one row of ids, cut every ``length`` ids.

    One row per piece: the columns of ``docs`` but its text, then ``start`` (ids of the document
    before the piece), ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id`` and ``offset`` (place in the sequence). Only the last sequence can be short.

    Pass 1 tokenizes and writes ids with the partition they are in and their place there; a
    running total of the partitions' ids gives each document its global offset; pass 2 cuts.
    No text or id is shuffled. A null or empty text is the end id alone; equal rows are packed
    each; an empty table gives no rows. Columns of the input named like the added ones are
    replaced; names that begin with an underscore are reserved.
    """
    spark = docs.sparkSession
    columns = [c for c in docs.columns if c not in {text, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"}]
    shipped = spark.sparkContext.broadcast(vocabulary_of(vocabulary))
    empty = docs.select(*columns, F.lit(b"").alias("_ids"), *[F.lit(0).cast("long").alias(c) for c in ("_n", "_at")])
    schema = empty.schema
    with_part = empty.withColumn("_source", F.lit(0)).schema
    path = scratch_path(spark, "ids")
    encoded = docs.select(*columns, text).mapInArrow(_tokenize(shipped, text, columns, end_id), schema)
    encoded.withColumn("_source", F.spark_partition_id()).write.option("compression", "zstd").parquet(path)
    written = spark.read.schema(with_part).parquet(path)
    totals = written.groupBy("_source").agg(F.sum("_n").alias("_total"))
    shifts = with_running_totals(totals, [F.col("_source")], {"_end": F.col("_total")})
    # One row per written partition.
    placed = written.join(F.broadcast(shifts), "_source").withColumn("_from", F.col("_end") - F.col("_total") + F.col("_at"))
    first, last = F.expr(f"_from div {length}L"), F.expr(f"(_from + _n - 1L) div {length}L")
    pieces = placed.withColumn("sequence_id", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("_from"), F.col("sequence_id") * length)
    stop = F.least(F.col("_from") + F.col("_n"), (F.col("sequence_id") + 1) * length)
    cut = pieces.withColumns({"start": begin - F.col("_from"), "length": stop - begin})
    ids = F.substring("_ids", (F.col("start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int"))
    return cut.select(*columns, "start", "length", ids.alias("ids"), F.col("_n").alias("doc_tokens"), "sequence_id", (begin - F.col("sequence_id") * length).alias("offset"))


def sequences(pieces: DataFrame, length: int = 2048, pad_id: int = 0) -> DataFrame:
    """One row per sequence: its ids padded to ``length``, and a boundary record per piece.

    Takes the pieces of ``pack`` whose documents are named by a column ``doc_id`` (null ids are
    kept as null, repeated rows are pieces of their own). No pieces give no sequences.
    """
    piece = F.struct("offset", "doc_id", "start", "length", "ids")
    grouped = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    ids = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    padding = F.expr(f"unhex(repeat('{pad_id.to_bytes(4, 'little').hex()}', cast({length} - octet_length(ids) div 4 as int)))")
    return grouped.select("sequence_id", ids.alias("ids"), F.transform("p", lambda x: x.dropFields("ids")).alias("boundaries")).withColumn(
        "ids", F.concat("ids", padding)
    )
