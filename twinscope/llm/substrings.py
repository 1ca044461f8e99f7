"""Repeated substrings by merged Burrows-Wheeler transforms of shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinscope.llm.components import written
from twinscope.llm.linededup import maybe_in
from twinscope.llm.textbytes import buffers, mix, powers, prefix_hashes, slices

#: Bytes whose hash can make a place an anchor.
GRAM = 16
#: Low bits of a window's sort key that hold the place; the rest is the gram's hash.
PLACE_BITS = 30
#: Phrases of a context end where the hash of eight bytes has these bits zero (32 bytes on average).
PHRASE_GRAM, PHRASE_MASK = 8, 31
#: Context bytes merged at once, and symbols of a shard.
CHUNK_BYTES = 3 << 19
SHARD_SYMBOLS = 1 << 14
#: Places of an anchor that meet in one group; more are dealt to several groups by hash.
GROUP_PLACES = 2000
#: The most frequent shared anchors, looked up by every task; a constant, not a share of the data.
HOT_ANCHORS = 1000


# --- anchors -------------------------------------------------------------------------------


def _grams(data: np.ndarray, width: int) -> np.ndarray:
    up, down = powers(len(data))
    total = prefix_hashes(data, up)
    n = len(data) - width + 1
    return mix((total[width:] - total[:n]) * down[:n])


def window_anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """For every window of ``length`` bytes inside a text its anchor: the place of its least gram.

    Equal windows have their anchor at the same place inside. Returns, for each run of windows
    with one anchor: text, anchor's place, first and last window start (all from the beginning
    of the slice), and the anchor's hash.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none.astype(np.uint64)
    hashes = _grams(data, GRAM)
    place = np.uint64((1 << PLACE_BITS) - 1)
    keys = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
    width = length - GRAM + 1
    n = len(data) - length + 1
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    grid = padded.reshape(blocks, width)
    before = np.minimum.accumulate(grid, axis=1).reshape(-1)
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    anchor = (np.minimum(after[:n], before[width - 1 : width - 1 + n]) & place).astype(np.int64)
    text = np.searchsorted(offsets, np.arange(n), side="right") - 1
    inside = np.arange(n) + length <= offsets[text + 1]
    change = np.ones(n, bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | ~inside[:-1]
    starts = np.flatnonzero(change & inside)
    # A run ends before the next change or where windows leave the text.
    ends = np.flatnonzero(inside & np.append(change[1:] | ~inside[1:], True))
    return text[starts], anchor[starts], starts, ends, hashes[anchor[starts]]


def _anchors(length: int):
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            data, offsets = buffers(batch.column("_text"))
            text, place, lo, hi, hashes = window_anchors(data, offsets, length)
            begin = offsets[text]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key").take(pa.array(text)), pa.array(hashes.view(np.int64)), *[pa.array(x - begin) for x in (place, lo, hi)]],
                ["_key", "anchor", "place", "lo", "hi"],
            )

    return anchors


def _contexts(length: int):
    """The bytes around each wanted anchor that its windows cover."""

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            data, offsets = buffers(batch.column("_text"))
            spots = batch.column("spots")
            flat = spots.flatten()
            row = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(spots).to_numpy())
            anchor, place, lo, hi, groups = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("anchor", "place", "lo", "hi", "groups"))
            raw = data.tobytes()
            cut = [raw[a:b] for a, b in zip((offsets[row] + lo).tolist(), (offsets[row] + hi + length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key").take(pa.array(row)), pa.array(anchor), pa.array(place), pa.array(lo), pa.array(groups), pa.array(cut, pa.binary())],
                ["_key", "anchor", "place", "lo", "groups", "context"],
            )

    return contexts


# --- merged transforms ---------------------------------------------------------------------


def shard_transform(codes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order and Burrows-Wheeler transform of a shard of strings, each ended by symbol 0.

    ``codes`` holds all strings with their end symbols; ``begins`` where each begins. The order
    comes from prefix doubling that does not look past an end symbol.
    """
    n = len(codes)
    ends = np.append(begins[1:], n) - 1
    left = np.repeat(ends, np.diff(np.append(begins, n))) - np.arange(n)  # symbols before the end
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    step = 1
    while step <= left.max(initial=0):
        ahead = np.zeros(n, np.int64)
        far = left >= step
        ahead[far] = rank[np.flatnonzero(far) + step] + 1
        new = np.unique(rank * (n + 2) + ahead, return_inverse=True)[1]
        if new.max() == rank.max():
            break
        rank, step = new, step * 2
    order = np.argsort(rank, kind="stable")
    before = codes[order - 1]
    first = np.zeros(n, bool)
    first[begins] = True
    return order, np.where(first[order], 0, before)


def merge_transforms(transforms: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Merge shard transforms by iterative interleave refinement.

    Returns the interleave (the shard of each suffix in merged order) and, for each suffix, the
    length of its common prefix with the one before it. The interleave starts as the shards one
    after the other; each round takes the symbols in the current order and sorts them stably, so
    after k rounds suffixes are ordered by k symbols. A round in which no block of suffixes with
    equal prefixes splits is the last. Suffixes that differ only in which text ends are split.
    """
    n = sum(map(len, transforms))
    shard = np.repeat(np.arange(len(transforms)), [len(t) for t in transforms])
    small = max((int(t.max(initial=0)) for t in transforms), default=0) < 1 << 16
    symbols = np.concatenate(transforms).astype(np.uint16 if small else np.int64) if transforms else np.zeros(0, np.int64)
    base = np.cumsum([0, *[len(t) for t in transforms]])[:-1]
    block = np.zeros(n, np.int64)
    common = np.full(n, -1, np.int64)
    rounds = 0
    while n:
        merged = np.empty(n, symbols.dtype)
        for s, start in enumerate(base):
            of = np.flatnonzero(shard == s)
            merged[of] = symbols[start : start + len(of)]
        order = np.argsort(merged, kind="stable")
        shard, merged, block = shard[order], merged[order], block[order]
        starts = np.ones(n, bool)
        starts[1:] = (merged[1:] != merged[:-1]) | (block[1:] != block[:-1]) | (merged[1:] == 0)
        fresh = starts & (common < 0)
        common[fresh] = rounds
        block = np.cumsum(starts)
        rounds += 1
        if not fresh.any():
            break
    return shard, np.maximum(common, 0)


def repeated_runs(codes: list[np.ndarray]) -> list[np.ndarray]:
    """For each symbol of each string, how many symbols from there on occur at another place too."""
    shards, at, size = [[]], 0, 0
    for k in range(len(codes)):
        if size > SHARD_SYMBOLS:
            shards.append([])
            size = 0
        shards[-1].append(k)
        size += len(codes[k]) + 1
    orders, transforms, firsts = [], [], []
    for strings in shards:
        ended = [np.append(codes[k], 0) for k in strings]
        begins = np.cumsum([0, *[len(e) for e in ended]])[:-1]
        order, bwt = shard_transform(np.concatenate(ended) if ended else np.zeros(0, np.int64), begins)
        orders.append(order)
        transforms.append(bwt)
        firsts.append(at)
        at += len(bwt)
    shard, common = merge_transforms(transforms)
    longest = np.maximum(common, np.append(common[1:], 0))
    run = np.zeros(at, np.int64)
    for s, order in enumerate(orders):
        run[firsts[s] + order] = longest[shard == s]
    cuts = np.cumsum([len(c) + 1 for c in codes])[:-1]
    return [r[:-1] for r in np.split(run, cuts)] if codes else []


def _phrases(data: np.ndarray, total: np.ndarray, down: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins of all phrases, and the first phrase of each context (one more than contexts)."""
    n = len(data) - PHRASE_GRAM + 1
    cut = np.zeros(len(data), bool)
    if n > 0:
        h = mix((total[PHRASE_GRAM:] - total[:n]) * down[:n])
        ends = np.flatnonzero((h & np.uint64(PHRASE_MASK)) == 0) + PHRASE_GRAM
        # A gram that began before its context does not count.
        ends = ends[ends < len(data)]
        own = offsets[np.searchsorted(offsets, ends, side="right") - 1]
        cut[ends[ends - PHRASE_GRAM >= own]] = True
    cut[offsets[:-1]] = True
    begins = np.flatnonzero(cut)
    return begins, np.searchsorted(begins, offsets)


def repeated_windows(contexts: pa.Array, anchor: np.ndarray, relative: np.ndarray, split: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Windows that also begin at another place of the same anchor: (context, start in it).

    Of contexts whose anchor is dealt to several groups (``split``) it also returns all other
    windows and one of each sort of repeated ones, with their hash and whether they are settled,
    as they may have equals in other groups: (context, start, hash, settled).

    ``relative`` is where each context begins, seen from its anchor. Contexts become strings of
    phrases, whose symbols hold content, anchor and place relative to it, so equal symbols are
    equal bytes at the same place of equal windows. Runs of phrases that occur twice come from
    the merged transforms; windows inside such a run repeat. Windows whose inner phrases repeat
    while their edges cut phrases are compared exactly, by the hash of all their bytes.
    """
    data, offsets = buffers(contexts)
    up, down = powers(len(data) + 1)
    total = prefix_hashes(data, up)
    begins, per = _phrases(data, total, down, offsets)
    stops = np.append(begins[1:], len(data))
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(per))
    seen_from = relative[owner] + begins - offsets[owner]
    content = mix((total[stops] - total[begins]) * down[begins])
    group = mix(anchor.view(np.uint64))
    symbols = mix(content ^ mix(seen_from.astype(np.uint64) + group[owner]))
    codes = np.unique(symbols, return_inverse=True)[1].astype(np.int64) + 1
    runs = np.concatenate(repeated_runs(np.split(codes, per[1:-1])))
    # Bytes of the repeated run from each phrase on.
    index = np.arange(len(begins))
    del content, symbols, codes, seen_from
    reach = np.where(runs > 0, stops[np.maximum(index + runs - 1, 0)], begins)
    # All windows of all contexts.
    n_windows = np.diff(offsets) - length + 1
    of = np.repeat(np.arange(len(n_windows)), n_windows)
    start = np.arange(len(of)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows) + offsets[of]
    outer = np.searchsorted(begins, start, side="right") - 1
    # A run that covers the window may begin at any phrase of its context before it.
    base = owner * (len(data) + 1)
    best = np.maximum.accumulate(reach + base) - base
    sure = best[outer] >= start + length
    del outer, best, base
    # Phrase ends whose gram lies in the window are the same in all equal windows.
    inner = np.minimum(np.searchsorted(begins, start + PHRASE_GRAM), len(begins) - 1)
    last = np.minimum(np.searchsorted(begins, start + length, side="right"), per[of + 1]) - 1
    likely = ~sure & ((last <= inner) | (reach[inner] >= begins[last]))
    del inner, last
    spot = mix((relative[of] + start - offsets[of]).astype(np.uint64) + group[of])
    asked = np.isin(spot, np.unique(spot[likely]))
    full = np.flatnonzero(asked)
    whole = mix((total[start[full] + length] - total[start[full]]) * down[start[full]]) ^ spot[full]
    _, back, count = np.unique(mix(whole), return_inverse=True, return_counts=True)
    sure[full[count[back] > 1]] = True
    del full, whole, back, asked, likely
    local = start - offsets[of]
    shared = np.flatnonzero(split[of])
    whole = mix((total[start[shared] + length] - total[start[shared]]) * down[start[shared]] ^ spot[shared])
    one = np.zeros(len(shared), bool)
    one[np.unique(whole, return_index=True)[1]] = True
    shared, whole = shared[one | ~sure[shared]], whole[one | ~sure[shared]]
    return of[sure], local[sure], of[shared], local[shared], whole, sure[shared]


def _decide(length: int):
    """Contexts that come ordered by group: chunks of whole groups are merged and decided.

    Rows out are byte ranges that repeated windows cover (``hash`` null), joined where starts
    follow each other, and windows that other groups may have too (see ``repeated_windows``).
    """

    def settle(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        chunk = pa.Table.from_batches(rows).combine_chunks()
        # A row may come twice (equal rows of the input): it is one place.
        chunk = chunk.group_by(["_key", "anchor", "place", "lo", "groups", "context"]).aggregate([]).combine_chunks()
        column = lambda c: chunk.column(c).to_numpy()
        keys, lo = chunk.column("_key").combine_chunks(), column("lo")
        of, start, open_of, open_start, whole, settled = repeated_windows(
            chunk.column("context").combine_chunks(), column("anchor"), lo - column("place"), column("groups") > 1, length
        )
        cut = np.ones(len(of), bool)
        cut[1:] = (of[1:] != of[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(of))[: len(first)] - 1
        owner = np.concatenate([of[first], open_of])
        begin = np.concatenate([lo[of[first]] + start[first], lo[open_of] + open_start])
        stop = np.concatenate([lo[of[first]] + start[last] + length, lo[open_of] + open_start + length])
        hashes = pa.concat_arrays([pa.nulls(len(first), pa.int64()), pa.array(whole.view(np.int64))])
        settled = pa.array(np.concatenate([np.ones(len(first), bool), settled]))
        return pa.RecordBatch.from_arrays([keys.take(pa.array(owner)), pa.array(begin), pa.array(stop), hashes, settled], ["_key", "start", "stop", "hash", "settled"])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches, "context", CHUNK_BYTES):
            if held and size >= CHUNK_BYTES:
                # Rows of the last group so far stay with it.
                same = int((batch.column("group").to_numpy() == held[-1].column("group")[-1].as_py()).cumprod().sum())
                if same:
                    held.append(batch.slice(0, same))
                    batch = batch.slice(same)
                if batch.num_rows:
                    yield settle(held)
                    held, size = [], 0
            if batch.num_rows:
                held.append(batch)
                size += pa.compute.sum(pa.compute.binary_length(batch.column("context"))).as_py()
        if held:
            yield settle(held)

    return decide


def _cut_out(text: str, columns: list[str]):
    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            removed, spans, kept = [], [], []
            data, offsets = buffers(batch.column(text))
            raw = data.tobytes()
            for k, (ranges, all_of_it) in enumerate(zip(batch.column("_ranges").to_pylist(), batch.column("_whole").to_pylist(), strict=True)):
                body = raw[offsets[k] : offsets[k + 1]]
                if all_of_it:
                    ranges = [{"start": 0, "stop": len(body)}]
                out, at, n = [], 0, 0
                for r in sorted(ranges or [], key=lambda r: (r["start"], r["stop"])):
                    if n and r["start"] <= at:
                        at = max(at, r["stop"])
                    else:
                        out.append(body[at : r["start"]])
                        at, n = r["stop"], n + 1
                out.append(body[at:])
                kept.append(b"".join(out))
                spans.append(n)
                removed.append(len(body) - len(kept[-1]))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                [*columns, "n_removed", "n_spans", "kept"],
            )

    return cut_out


def remove_repeats(docs: DataFrame, length: int = 400, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` with ``n_removed``, ``n_spans`` and ``kept`` (bytes of the text that stay).

    Removed is each UTF-8 byte covered by a string of ``length`` bytes that begins at another
    place of any text too, the same one included; matches never cross texts and are judged on
    the input. Equal texts are collapsed first: each of two or more equal texts of ``length``
    bytes goes as a whole, and stands once for comparison with others.

    Every window has an anchor, its least gram. Only windows whose anchor occurs at two places
    can repeat, so only the contexts of such anchors (two fifths to three times ``length``
    bytes) meet, by anchor. Shards of these contexts are transformed and merged; see
    ``repeated_windows``. The places of a frequent anchor are dealt to several groups of about
    ``GROUP_PLACES``; windows without an equal in their group meet those of other groups by
    hash, so no task gathers a frequent anchor and none of its repeats is missed. The
    ``HOT_ANCHORS`` most frequent ones are told to all tasks, so their places aren't shuffled to
    learn that they are shared.

    Windows that phrases or groups cut are compared by a 64-bit hash of all their bytes, not byte
    by byte.

    A null or empty text is empty; null ids and repeated rows are texts like others (equal rows
    are equal texts). Columns of ``docs`` named like the added ones are replaced; names that
    begin with an underscore are reserved.
    """
    docs = docs.drop("n_removed", "n_spans", "kept")
    columns = docs.columns
    keyed = docs.withColumn("_key", F.unhex(F.md5(F.coalesce(text, F.lit("")))))
    source = keyed.select("_key", F.col(ident).alias("_id"), F.coalesce(text, F.lit("")).alias("_text")).where(F.octet_length("_text") >= length)
    copies = source.groupBy("_key").agg(F.count(F.lit(1)).alias("copies"), F.min("_id").alias("_least"))
    spot_schema = "_key binary, anchor long, place long, lo long, hi long"
    anchors = written(source.select("_key", "_text").mapInArrow(_anchors(length), spot_schema), "anchors")
    place = F.xxhash64("_key", "place")
    counted = anchors.groupBy("anchor").agg(F.min(place).alias("_a"), F.max(place).alias("_b"), F.count(F.lit(1)).alias("_m"))
    shared = written(counted.where("_a <> _b").select("anchor", F.ceil(F.col("_m") / GROUP_PLACES).alias("groups"), "_m"), "shared")
    hot = shared.orderBy(F.col("_m").desc(), "anchor").limit(HOT_ANCHORS).select("anchor", "groups")
    met = anchors.join(F.broadcast(hot), "anchor", "left")
    others = met.where("groups is null").drop("groups").join(shared.select("anchor", "groups"), "anchor")
    spots = met.where("groups is not null").unionByName(others).groupBy("_key").agg(F.collect_set(F.struct("anchor", "place", "lo", "hi", "groups")).alias("spots"))
    wanted = copies.join(spots, "_key", "left")
    once = source.join(wanted.where(F.col("spots").isNotNull()), "_key").where(F.col("_id").eqNullSafe(F.col("_least")))
    contexts = once.select("_key", "_text", "spots").mapInArrow(
        _contexts(length), "_key binary, anchor long, place long, lo long, groups long, context binary"
    )
    group = F.xxhash64("anchor", F.pmod(F.xxhash64("_key", "place"), F.col("groups")))
    grouped = contexts.withColumn("group", group).repartition("group").sortWithinPartitions("group")
    found = written(grouped.mapInArrow(_decide(length), "_key binary, start long, stop long, hash long, settled boolean"), "windows")
    windows = found.where("hash is not null")
    at = F.xxhash64("_key", "start")
    twice = windows.groupBy("hash").agg(F.min(at).alias("_a"), F.max(at).alias("_b")).where("_a <> _b").select("hash")
    late = windows.where("not settled").join(twice, "hash").select("_key", "start", "stop")
    covered = found.where("hash is null").select("_key", "start", "stop").unionByName(late)
    ranges = covered.groupBy("_key").agg(F.collect_set(F.struct("start", "stop")).alias("_ranges"))
    marks = copies.join(ranges, "_key", "left").select("_key", "_ranges", (F.col("copies") > 1).alias("_whole"))
    marks = written(marks.where("_whole or _ranges is not null"), "marks")
    # Texts of which nothing goes stay where they are.
    n, unmarked = marks.count(), {"_ranges": F.lit(None).cast(marks.schema["_ranges"].dataType), "_whole": F.lit(False)}
    joined = maybe_in(keyed, marks, "_key", n).join(marks, "_key", "left").withColumn("_whole", F.coalesce("_whole", F.lit(False)))
    marked = joined.unionByName(maybe_in(keyed, marks, "_key", n, outside=True).withColumns(unmarked))
    schema = docs.withColumns({"n_removed": F.lit(0).cast("long"), "n_spans": F.lit(0).cast("long"), "kept": F.lit(b"")}).schema
    return marked.select(*columns, "_ranges", "_whole").mapInArrow(_cut_out(text, columns), schema)
