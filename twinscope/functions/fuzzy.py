"""Edit-ratio scores of text pairs, 0 to 100.

The string rewriting (clean-up, token sorting, token sets) and the weighting are
Spark expressions. Only two quantities have no Spark expression and come from one
Arrow UDF: the longest common subsequence of two strings, and the best one over
all windows of the longer string that are as long as the shorter string.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCORES = [
    "fuzz_qratio",
    "fuzz_WRatio",
    "fuzz_partial_ratio",
    "fuzz_partial_token_set_ratio",
    "fuzz_partial_token_sort_ratio",
    "fuzz_token_set_ratio",
    "fuzz_token_sort_ratio",
]

_BATCH_CELLS = 4_000_000  # state held by one vectorised window search
_BOUND_CELLS = 1_000_000  # alignment grids from here on are bounded before they are searched

# What each score needs: ratios of whole strings, and of the best window ("part").
_PARTS = ("full", "sorted", "sets", "part", "part_full", "part_sorted", "part_sets")
_NEEDS = {
    "fuzz_qratio": {"full"},
    "fuzz_WRatio": {"full", "sorted", "sets", "part_full", "part_sorted", "part_sets"},
    "fuzz_partial_ratio": {"part"},
    "fuzz_partial_token_set_ratio": {"part_sets"},
    "fuzz_partial_token_sort_ratio": {"part_sorted"},
    "fuzz_token_set_ratio": {"sets"},
    "fuzz_token_sort_ratio": {"sorted"},
}


def _percent(common: int, total: int) -> int:
    return int(round(100 * (2 * common / total)))


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, one machine-word-parallel step per character of b."""
    if len(a) > len(b):
        a, b = b, a
    lead = 0
    while lead < len(a) and a[lead] == b[lead]:
        lead += 1
    a, b = a[lead:], b[lead:]
    tail = 0
    while tail < len(a) and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    if tail:
        a, b = a[:-tail], b[:-tail]
    if not a:
        return lead + tail
    codes = np.frombuffer(a.encode("utf-32-le"), dtype=np.uint32)
    masks = {
        chr(c): int.from_bytes(np.packbits(codes == c, bitorder="little").tobytes(), "little")
        for c in np.unique(codes)
    }
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & masks.get(ch, 0)
        row = (row + hit) | (row - hit)
    return lead + tail + len(a) - (row & full).bit_count()


def ratio(a: str, b: str) -> int:
    if a == b:
        return 100
    if not a or not b:
        return 0
    return _percent(lcs_length(a, b), len(a) + len(b))


def _window_lcs(shorts: list[str], longs: list[str]) -> list[tuple[int, int]]:
    """``(best window, whole)`` common subsequence of many string pairs at once.

    Semi-local LCS by combing (Tiskin): every cell of the alignment grid either
    crosses or keeps two strands, and the final strand order answers all windows.
    The grid is walked by anti-diagonals, each a numpy step over every pair. Padding
    characters match nothing, so pairs of different sizes share a batch.
    """
    m, n, size = max(map(len, shorts)), max(map(len, longs)), len(shorts)
    rows = np.full((m, size), -1, dtype=np.int32)
    cols = np.full((n, size), -2, dtype=np.int32)
    for k, (s, t) in enumerate(zip(shorts, longs)):
        rows[m - len(s):, k] = np.frombuffer(s.encode("utf-32-le"), dtype=np.int32)[::-1]
        cols[: len(t), k] = np.frombuffer(t.encode("utf-32-le"), dtype=np.int32)
    if max(rows.max(), cols.max()) < 32767:
        rows, cols = rows.astype(np.int16), cols.astype(np.int16)
    kind = np.int16 if m + n < 32767 else np.int32
    across = np.repeat(np.arange(m, dtype=kind)[:, None], size, axis=1)
    down = np.repeat(np.arange(m, m + n, dtype=kind)[:, None], size, axis=1)
    for d in range(m + n - 1):
        lo, hi = m - 1 - min(d, m - 1), m - max(0, d - n + 1)
        shift = d - m + 1
        x, y = across[lo:hi], down[lo + shift:hi + shift]
        swap = rows[lo:hi] == cols[lo + shift:hi + shift]
        np.logical_or(swap, x > y, out=swap)
        delta = x ^ y
        delta *= swap.view(np.int8).astype(kind)
        x ^= delta
        y ^= delta
    best = []
    for k, (s, t) in enumerate(zip(shorts, longs)):
        width, last = len(s), len(t) - len(s)
        start = down[: len(t), k].astype(np.int64) - m
        end = np.flatnonzero(start >= 0)
        whole = len(t) - len(end)
        start = np.minimum(start[end], last)
        first = np.maximum(end - width + 1, 0)
        covers = first <= start
        step = np.zeros(last + 2, dtype=np.int64)
        np.add.at(step, first[covers], 1)
        np.add.at(step, start[covers] + 1, -1)
        best.append((int(width - np.cumsum(step)[: last + 1].min()), whole))
    return best


def candidate_windows(short: str, long: str) -> tuple[int, list[tuple[int, int]]]:
    """A length that some window's common subsequence reaches, and the ranges of window starts
    (first, last) that could have a longer one.

    No common subsequence is longer than the characters that both strings hold, counted with
    repeats; these counts slide along the longer string in linear time per character. The window
    with the largest count is aligned exactly.
    """
    m, last = len(short), len(long) - len(short)
    a = np.frombuffer(short.encode("utf-32-le"), dtype=np.uint32)
    b = np.frombuffer(long.encode("utf-32-le"), dtype=np.uint32)
    bound = np.zeros(last + 1, dtype=np.int64)
    for c, n in zip(*np.unique(a, return_counts=True)):
        seen = np.concatenate([[0], np.cumsum(b == c)])
        bound += np.minimum(seen[m:] - seen[: last + 1], n)
    best = int(bound.argmax())
    reached = lcs_length(short, long[best : best + m])
    open_ = np.concatenate([[False], bound > reached, [False]])
    edges = np.flatnonzero(open_[1:] != open_[:-1])
    return reached, [(int(i), int(j) - 1) for i, j in zip(edges[::2], edges[1::2])]


def partial_ratios(
    pairs: Iterable[tuple[str, str]], ratios: dict[tuple[str, str], int] | None = None
) -> dict[tuple[str, str], int]:
    """Best-window ratio of every distinct pair.

    The window search yields the whole-string ratio too; it is put into ``ratios``.
    """
    out: dict[tuple[str, str], int] = {}
    hard = []
    for a, b in set(pairs):
        s, t = (a, b) if len(a) <= len(b) else (b, a)
        if a == b or (s and s in t):
            out[a, b] = 100
        elif not s:
            out[a, b] = 0
        elif len(s) == len(t):
            out[a, b] = ratio(a, b)
        elif len(s) * len(t) < _BOUND_CELLS:
            hard.append((len(s), len(t), s, t, a, b))
        else:
            m = len(s)
            reached, ranges = candidate_windows(s, t)
            out[a, b] = _percent(reached, 2 * m)
            if sum(j - i + m for i, j in ranges) < 0.9 * len(t):
                hard += [(m, j - i + m, s, t[i : j + m], a, b) for i, j in ranges]
            else:
                hard.append((m, len(t), s, t, a, b))
    hard.sort(key=lambda h: (int(np.log(h[0]) * 5), h[1]))
    batch: list[tuple] = []

    def flush() -> None:
        best = _window_lcs([h[2] for h in batch], [h[3] for h in batch])
        for (m, n, _, _, a, b), (window, whole) in zip(batch, best):
            out[a, b] = max(out.get((a, b), 0), _percent(window, 2 * m))
            if ratios is not None and n == max(len(a), len(b)):
                ratios[a, b] = _percent(whole, m + n)
        batch.clear()

    for h in hard:
        if batch and (
            int(np.log(h[0]) * 5) != int(np.log(batch[0][0]) * 5)
            or h[1] > 1.2 * batch[0][1] + 16
            or (len(batch) + 1) * (h[0] + h[1]) > _BATCH_CELLS
        ):
            flush()
        batch.append(h)
    if batch:
        flush()
    return out


def _kernel(needed: Iterable[str]):
    """An Arrow UDF with one integer field for each needed part; it computes no other."""
    parts = tuple(p for p in _PARTS if p in set(needed))

    @F.arrow_udf(T.StructType([T.StructField(n, T.IntegerType()) for n in parts]))
    def kernel(
        raw1: pa.Array, raw2: pa.Array,
        full1: pa.Array, full2: pa.Array,
        sorted1: pa.Array, sorted2: pa.Array,
        sets1: pa.Array, sets2: pa.Array,
        wide: pa.Array, apart: pa.Array,
    ) -> pa.Array:
        columns = (raw1, raw2, full1, full2, sorted1, sorted2, sets1, sets2, wide, apart)
        raw1, raw2, full1, full2, sorted1, sorted2, sets1, sets2, wide, apart = (c.to_pylist() for c in columns)
        strings = {
            "full": lambda: zip(full1, full2),
            "sorted": lambda: zip(sorted1, sorted2),
            "sets": lambda: zip(sets1, sets2),
            "part": lambda: zip(raw1, raw2),
            "part_full": lambda: ((a, b) if w else ("", "") for a, b, w in zip(full1, full2, wide)),
            "part_sorted": lambda: zip(sorted1, sorted2),
            "part_sets": lambda: ((a, b) if w else ("", "") for a, b, w in zip(sets1, sets2, apart)),
        }
        pairs = {p: list(strings[p]()) for p in parts}
        known: dict[tuple[str, str], int] = {}
        best = partial_ratios((ab for p in parts if p.startswith("part") for ab in pairs[p]), known)

        def whole(a: str, b: str) -> int:
            if (a, b) not in known:
                known[a, b] = ratio(a, b)
            return known[a, b]

        found = [[best[ab] if p.startswith("part") else whole(*ab) for ab in pairs[p]] for p in parts]
        return pa.StructArray.from_arrays([pa.array(f, pa.int32()) for f in found], list(parts))

    return kernel


def full_process(c: Column) -> Column:
    """Drop non-ASCII, turn other non-word characters into spaces, lower, trim."""
    # Java goes over a negated list of ranges about twenty times as slowly as over \w, the same ASCII characters.
    # A space stays one, so it needs no match.
    ascii_only = F.regexp_replace(c, r"[^\x00-\x7f]+", "")
    return F.trim(F.lower(F.regexp_replace(ascii_only, r"[^\w ]", " ")))


def _round_half_even(c: Column) -> Column:
    return F.rint(c)


def with_fuzzy_scores(
    df: DataFrame, left: str, right: str, scores: Iterable[str] = SCORES, beside: dict[str, Column] | None = None
) -> DataFrame:
    """Add scores of ``SCORES`` as long columns, by default all seven; only what they need is computed.

    The columns ``beside`` are added in the same step as the kernel's."""
    beside = beside or {}
    kept, wanted = [*df.columns, *beside], list(scores)
    needed = set().union(*(_NEEDS[n] for n in wanted))
    df = df.withColumns({"_p1": full_process(F.col(left)), "_p2": full_process(F.col(right))})
    df = df.withColumns(
        {f"_t{k}": F.sort_array(F.array_remove(F.split(F.col(f"_p{k}"), " +"), "")) for k in (1, 2)}
    )
    df = df.withColumns(
        {
            "_s1": F.array_join("_t1", " "),
            "_s2": F.array_join("_t2", " "),
            "_sect": F.array_join(F.sort_array(F.array_intersect("_t1", "_t2")), " "),
            "_d1": F.array_join(F.sort_array(F.array_except("_t1", "_t2")), " "),
            "_d2": F.array_join(F.sort_array(F.array_except("_t2", "_t1")), " "),
            "_l1": F.length("_p1"),
            "_l2": F.length("_p2"),
        }
    )
    df = df.withColumns(
        {
            "_c1": F.trim(F.concat_ws(" ", "_sect", "_d1")),
            "_c2": F.trim(F.concat_ws(" ", "_sect", "_d2")),
            "_valid": (F.col("_l1") > 0) & (F.col("_l2") > 0),
            "_apart": F.length("_sect") == 0,
            "_span": F.greatest("_l1", "_l2") / F.greatest(F.lit(1), F.least("_l1", "_l2")),
        }
    )
    kernel = _kernel(needed)(
        F.col(left), F.col(right), "_p1", "_p2", "_s1", "_s2", "_c1", "_c2",
        (F.col("_span") >= 1.5) & F.col("_valid"), F.col("_apart") & F.col("_valid"),
    )
    df = df.withColumns({"_k": kernel, **beside})

    def prefix_ratio(longer: Column) -> Column:
        """Ratio of the shared tokens against a string that starts with them."""
        shared, whole = F.length("_sect"), F.length(longer)
        # the scores of the pair as a whole are unchanged when nothing is shared
        total = F.when(shared > 0, (shared + whole).cast("double"))
        return F.coalesce(_round_half_even(100 * (2.0 * shared / total)), F.lit(0.0))

    def token_set() -> Column:
        return F.greatest(prefix_ratio(F.col("_c1")), prefix_ratio(F.col("_c2")), F.col("_k.sets").cast("double"))

    def partial_set() -> Column:
        return F.when(F.col("_apart"), F.col("_k.part_sets")).otherwise(100).cast("double")

    def weighted() -> Column:
        scale = F.when(F.col("_span") > 8, 0.6).otherwise(0.9)
        return F.when(
            F.col("_span") < 1.5,
            F.greatest(F.col("_k.full").cast("double"), F.col("_k.sorted") * 0.95, token_set() * 0.95),
        ).otherwise(
            F.greatest(
                F.col("_k.full").cast("double"),
                F.col("_k.part_full") * scale,
                F.col("_k.part_sorted") * 0.95 * scale,
                partial_set() * 0.95 * scale,
            )
        )

    def valid(score: Column) -> Column:
        return F.when(F.col("_valid"), score).otherwise(F.lit(0))

    columns = {
        "fuzz_qratio": lambda: valid(F.col("_k.full")),
        "fuzz_WRatio": lambda: valid(_round_half_even(weighted())),
        "fuzz_partial_ratio": lambda: F.col("_k.part"),
        "fuzz_partial_token_set_ratio": lambda: valid(partial_set()),
        "fuzz_partial_token_sort_ratio": lambda: F.col("_k.part_sorted"),
        "fuzz_token_set_ratio": lambda: valid(token_set()),
        "fuzz_token_sort_ratio": lambda: F.col("_k.sorted"),
    }
    return df.select(*kept, *[columns[n]().cast("long").alias(n) for n in wanted])
