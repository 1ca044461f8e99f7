"""Token counts of a word-piece vocabulary: words proved to be one token are counted, the rest is merged."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinscope.llm.textbytes import slices

#: The character that stands for a space inside the vocabulary (fixed value).
SPACE = "▁"
#: Bytes of text whose words are counted at once.
BLOCK_BYTES = 8 << 20


def model_bytes(path: str | None) -> bytes:
    """A sentence-piece model file; by default the public one with 32k pieces."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return Path(path).read_bytes()


def prove_whole_tokens(model: bytes) -> list[str]:
    """Words (without the space before them) that encode alone as one token, proved for this model.

    Three facts make counts of words add up to the count of a text, and each is checked here:
    the model takes texts as they are, with one space put before; it merges pairs of neighbours
    by rank alone; and no piece holds a space after another character, so no merge crosses the
    place before a run of spaces. A model without them is refused.
    """
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    rules = proto.normalizer_spec
    if rules.precompiled_charsmap or not rules.add_dummy_prefix or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
        raise ValueError("the model changes texts before it cuts them")
    if proto.trainer_spec.model_type != 2 or proto.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("the model doesn't merge pairs, or puts spaces after words")
    kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
    words = []
    for piece in proto.pieces:
        if piece.type == kinds.USER_DEFINED:
            raise ValueError("the model has pieces that are cut out before merging")
        if piece.type != kinds.NORMAL:
            continue
        if SPACE in piece.piece.lstrip(SPACE):
            raise ValueError(f"a piece goes on across a space: {piece.piece!r}")
        if piece.piece.startswith(SPACE) and not piece.piece.startswith(SPACE * 2) and piece.piece != SPACE:
            words.append(piece.piece[1:])
    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    if processor.is_unknown(processor.piece_to_id(SPACE)):
        raise ValueError("a lone space is no piece")
    return [w for w, ids in zip(words, processor.encode(words), strict=True) if len(ids) == 1]


class Counter:
    """Counts the tokens of Arrow texts; one per task."""

    def __init__(self, model: bytes, whole: list[str]):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        # A last word without characters is the piece of a lone space.
        self.whole = pa.array([*whole, ""], pa.large_string())

    def of_words(self, words: pa.Array) -> np.ndarray:
        """Tokens of each distinct word with a space before it."""
        n = np.ones(len(words), np.int64)
        rest = np.flatnonzero(~pc.is_in(words, value_set=self.whole).to_numpy(zero_copy_only=False))
        if len(rest):
            merged = self.processor.encode(words.take(pa.array(rest)).to_pylist(), num_threads=1)
            n[rest] = [len(ids) for ids in merged]
        return n

    def of_texts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; null and empty texts have none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        texts = pc.replace_substring(texts, SPACE, " ")
        cut = pc.split_pattern(texts, " ")
        # Each text gives one word more than it has spaces, so none gives an empty list.
        begins = cut.offsets.to_numpy()[:-1] - cut.offsets[0].as_py()
        words = cut.flatten()
        coded = words.dictionary_encode()
        n = self.of_words(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        empty = pc.equal(pc.utf8_length(words), 0).to_numpy(zero_copy_only=False)
        if empty.any():
            n = self._with_runs(words, n, empty, begins)
        counts = np.add.reduceat(n, begins) if len(begins) else np.zeros(0, np.int64)
        counts[pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)] = 0
        return counts

    def _with_runs(self, words: pa.Array, n: np.ndarray, empty: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Spaces in a row, and those at the end of a text, belong to the word after the last of them."""
        last = np.zeros(len(n), bool)
        last[np.append(begins[1:], len(n)) - 1] = True
        # An empty word that has another one after it in its text is only a space of that one's run.
        leading = empty & ~last
        n = np.where(leading, 0, n)
        heads = np.flatnonzero(~leading)
        runs = heads - np.append(-1, heads[:-1]) - 1
        long = np.flatnonzero(runs > 0)
        if len(long):
            found = words.take(pa.array(heads[long])).to_pylist()
            texts = pa.array([" " * k + w for k, w in zip(runs[long].tolist(), found, strict=True)], pa.large_string()).dictionary_encode()
            counted = np.array([len(ids) for ids in self.processor.encode(texts.dictionary.to_pylist(), num_threads=1)], np.int64)
            n[heads[long]] = counted[texts.indices.to_numpy()]
        return n


def _count(model, whole, text: str, columns: list[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(model.value, whole.value)
        for batch in slices(batches, text, BLOCK_BYTES):
            n = counter.of_texts(batch.column(text))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(n)], [*columns, "n_tokens"])

    return count


def count_tokens(docs: DataFrame, text: str = "text", model: str | None = None) -> DataFrame:
    """Rows of ``docs`` with ``n_tokens``: how many tokens the model's library gives for the whole
    text, without tokens for its begin and end.

    The driver proves which vocabulary strings encode alone as one token (a list bounded by the
    vocabulary); tasks cut texts before runs of spaces, count the words among those directly and
    let the library merge each other distinct word of a block once. Rows are not shuffled.

    A null or empty text has no tokens; null ids, ties and repeated rows are counted each; an empty
    table gives no rows. A column of ``docs`` named ``n_tokens`` is replaced.
    """
    docs = docs.drop("n_tokens")
    context = docs.sparkSession.sparkContext
    proto = model_bytes(model)
    shipped, whole = context.broadcast(proto), context.broadcast(prove_whole_tokens(proto))
    schema = docs.withColumn("n_tokens", F.lit(0).cast("long")).schema
    return docs.mapInArrow(_count(shipped, whole, text, docs.columns), schema)
