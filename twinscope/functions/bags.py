"""Word-bag arithmetic on array columns.

Vectors, their sums, weighted cosines and common n-grams of many pairs come from Arrow UDFs: the words of a
batch get numbers in byte order, and all pairs are sorted at once.

Arrays that are read more than once are materialised as columns by the callers
(one ``select`` per step); Catalyst keeps such a projection separate instead of
evaluating the array again at every use.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of both sides that are gone through at once; one pair may have more.
_CHUNK_WORDS = 1 << 20

DISTANCES = [
    "cosine_distance",
    "cityblock_distance",
    "jaccard_distance",
    "canberra_distance",
    "euclidean_distance",
    "minkowski_distance",
    "braycurtis_distance",
]


def _chunks(tokens1: pa.Array, tokens2: pa.Array):
    """Runs of pairs with ``_CHUNK_WORDS`` words at most, or of one pair: of each side the words'
    numbers in byte order and each pair's count of words, and how many numbers there are."""
    sides = [t.chunk(0) if isinstance(t, pa.ChunkedArray) and t.num_chunks == 1 else t for t in (tokens1, tokens2)]
    counts = [pc.fill_null(pc.list_value_length(t), 0).to_numpy(zero_copy_only=False).astype(np.int64) for t in sides]
    upto = np.concatenate([[0], np.cumsum(counts[0] + counts[1])])
    begin = 0
    while begin < len(counts[0]):
        end = max(begin + 1, int(np.searchsorted(upto, upto[begin] + _CHUNK_WORDS, "right")) - 1)
        flat = [t.slice(begin, end - begin).flatten() for t in sides]
        words = pa.concat_arrays([f.cast(pa.large_binary()) for f in flat]).dictionary_encode()
        order = pc.sort_indices(words.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        numbers = rank[words.indices.to_numpy()]
        at = len(flat[0])
        yield (numbers[:at], numbers[at:]), [c[begin:end] for c in counts], max(len(order), 1)
        begin = end


def _pair_vectors(numbers, counts, size: int) -> list[np.ndarray]:
    """The vectors of all pairs of a chunk, end to end: each side's sorted word numbers (from 1,
    within the pair), padded on the left with zeros by the length of the other side."""
    n1, n2 = counts
    pairs = np.arange(len(n1))
    keys = [np.sort(np.repeat(pairs * size, n) + x) for x, n in zip(numbers, counts)]
    both = np.sort(np.concatenate(keys), kind="stable")
    vocab = both[np.append(True, both[1:] != both[:-1])] if len(both) else both
    first = np.searchsorted(vocab, pairs * size)
    begins = np.cumsum(n1 + n2) - n1 - n2
    out = []
    for own, other, key in ((n1, n2, keys[0]), (n2, n1, keys[1])):
        vector = np.zeros(int((n1 + n2).sum()), np.int64)
        place = np.arange(len(key)) + np.repeat(begins + other - np.cumsum(own) + own, own)
        vector[place] = np.searchsorted(vocab, key) - np.repeat(first, own) + 1
        out.append(vector)
    return out


def _nulls(tokens1: pa.Array, tokens2: pa.Array) -> pa.Array:
    return pc.or_(tokens1.is_null(), tokens2.is_null())


@F.arrow_udf(T.StructType([T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("vec1", "vec2")]))
def _vectors(tokens1: pa.Array, tokens2: pa.Array) -> pa.Array:
    parts, sizes = ([], []), [np.zeros(1, np.int64)]
    for numbers, counts, size in _chunks(tokens1, tokens2):
        for part, vector in zip(parts, _pair_vectors(numbers, counts, size)):
            part.append(vector.astype(np.int32))
        sizes.append(counts[0] + counts[1])
    none = _nulls(tokens1, tokens2)
    offsets = pa.array(np.cumsum(np.concatenate(sizes)).astype(np.int32))
    fields = [
        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, np.int32), *p])))
        for p in parts
    ]
    fields = [pc.if_else(none, pa.scalar(None, f.type), f) for f in fields]
    return pa.StructArray.from_arrays(fields, ["vec1", "vec2"])


def with_pair_vectors(df: DataFrame, tokens1: str, tokens2: str) -> DataFrame:
    """Add the integer vectors ``vec1`` and ``vec2`` of equal length."""
    df = df.withColumn("_vectors", _vectors(tokens1, tokens2))
    return df.withColumns({"vec1": F.col("_vectors.vec1"), "vec2": F.col("_vectors.vec2")}).drop("_vectors")


def _ratio(num: Column, den: Column, if_zero: float) -> Column:
    return F.when(den == 0, F.lit(if_zero)).otherwise(num / F.when(den != 0, den))


def _total(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)


_SUMS = ("dot", "uu", "vv", "l1", "sq", "tot", "can", "ne", "nz")


@F.arrow_udf(T.StructType([T.StructField(n, T.DoubleType()) for n in _SUMS]))
def _sums(tokens1: pa.Array, tokens2: pa.Array) -> pa.Array:
    parts: list[list[np.ndarray]] = [[np.zeros(0)] for _ in _SUMS]
    for numbers, counts, size in _chunks(tokens1, tokens2):
        u, v = (x.astype(float) for x in _pair_vectors(numbers, counts, size))
        pair = np.repeat(np.arange(len(counts[0])), counts[0] + counts[1])
        used = (u + v) > 0
        u, v, pair = u[used], v[used], pair[used]
        gap, tot = np.abs(u - v), u + v
        terms = (u * v, u * u, v * v, gap, gap * gap, tot, gap / tot, (u != v).astype(float), np.ones(len(u)))
        for part, term in zip(parts, terms):
            # Terms are added in the order of their places.
            part.append(np.bincount(pair, term, len(counts[0])))
    none = _nulls(tokens1, tokens2).to_numpy(zero_copy_only=False)
    return pa.StructArray.from_arrays([pa.array(np.concatenate(p), mask=none) for p in parts], list(_SUMS))


def vector_sums(tokens1: str, tokens2: str) -> Column:
    """The sums over a pair's vectors that the distances are made of, as a struct; no vector leaves the kernel."""
    return _sums(tokens1, tokens2)


def distances() -> dict[str, Column]:
    """All distances, from a column ``_sums`` of ``vector_sums``."""

    def c(name: str) -> Column:
        return F.col(f"_sums.{name}")

    cosine = F.lit(1.0) - _ratio(c("dot"), F.sqrt(c("uu")) * F.sqrt(c("vv")), float("nan"))
    return {
        "cosine_distance": cosine,
        "cityblock_distance": c("l1"),
        "jaccard_distance": _ratio(c("ne"), c("nz"), 0.0),
        "canberra_distance": c("can"),
        "euclidean_distance": F.sqrt(c("sq")),
        "minkowski_distance": F.sqrt(c("sq")),
        "braycurtis_distance": _ratio(c("l1"), c("tot"), float("nan")),
    }


def minkowski(vec1: Column, vec2: Column, p: float) -> Column:
    """Minkowski distance of any order; order 2 is what ``distances`` reports."""
    powers = F.zip_with(vec1, vec2, lambda u, v: F.pow(F.abs(u - v).cast("double"), F.lit(float(p))))
    return F.pow(_total(powers), F.lit(1.0 / p))


def _grams(numbers: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(pair, words) of every window of n words that lies in one text."""
    starts = np.arange(len(numbers)) + n <= np.repeat(np.cumsum(counts), counts)
    at = np.flatnonzero(starts)
    return np.repeat(np.arange(len(counts)), counts)[at], numbers[at[:, None] + np.arange(n)]


def _common_ngrams(n: int):
    @F.arrow_udf(T.LongType())
    def common(tokens1: pa.Array, tokens2: pa.Array) -> pa.Array:
        found = [np.zeros(0, np.int64)]
        for numbers, counts, size in _chunks(tokens1, tokens2):
            (pair1, words1), (pair2, words2) = (_grams(x, c, n) for x, c in zip(numbers, counts))
            keys, spread = np.concatenate([pair1, pair2]), len(counts[0])
            for k in range(n):
                if spread * size >= 1 << 62:
                    # The windows so far get numbers of their own.
                    keys = np.unique(keys, return_inverse=True)[1]
                    spread = int(keys.max(initial=0)) + 1
                keys = keys * size + np.concatenate([words1[:, k], words2[:, k]])
                spread *= size
            shared = np.isin(keys[: len(pair1)], keys[len(pair1) :])
            found.append(np.bincount(pair1[shared], minlength=len(counts[0])))
        return pa.array(np.concatenate(found).astype(np.int64))

    return common


def common_ngrams(tokens1: str, tokens2: str, n: int) -> Column:
    """How many n-grams of side one, repeats included, side two also has. A word has no space in it."""
    return _common_ngrams(n)(tokens1, tokens2)


def _tfidf_cosine(max_features: int | None):
    @F.arrow_udf(T.DoubleType())
    def cosine(tokens1: pa.Array, tokens2: pa.Array) -> pa.Array:
        found = [np.zeros(0)]
        for numbers, counts, size in _chunks(tokens1, tokens2):
            pairs, at = len(counts[0]), len(numbers[0])
            keys = np.concatenate([np.repeat(np.arange(pairs) * size, n) + x for n, x in zip(counts, numbers)])
            vocab, place = np.unique(keys, return_inverse=True)
            a, b = (np.bincount(p, minlength=len(vocab)) for p in (place[:at], place[at:]))
            pair = vocab // size
            if max_features is not None:
                order = np.lexsort((vocab, -(a + b), pair))
                rank = np.arange(len(order)) - np.searchsorted(pair, pair)
                order = order[rank < max_features]
                a, b, pair = a[order], b[order], pair[order]
            idf = np.where((a > 0) & (b > 0), 1.0, 1.0 + np.log(1.5))
            a, b = a * idf, b * idf
            dot, aa, bb = (np.bincount(pair, t, pairs) for t in (a * b, a * a, b * b))
            norm = np.sqrt(aa) * np.sqrt(bb)
            found.append(np.divide(dot, norm, out=np.zeros(pairs), where=norm > 0))
        none = _nulls(tokens1, tokens2).to_numpy(zero_copy_only=False)
        return pa.array(np.concatenate(found), mask=none)

    return cosine


def tfidf_cosine(tokens1: str, tokens2: str, max_features: int | None = None) -> Column:
    """Cosine of the sides' word counts, weighted by the smoothed inverse frequency over the two of them; with
    ``max_features`` of the words most frequent in both together, ties in byte order. Zero if a side has none."""
    return _tfidf_cosine(max_features)(tokens1, tokens2)
