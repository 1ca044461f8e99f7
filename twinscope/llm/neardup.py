"""MinHash near-duplicates by a multi-index Hamming join of b-bit signatures."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinscope.llm.components import connected_components, written
from twinscope.llm.linededup import maybe_in
from twinscope.llm.textbytes import WHITE_SPACE, buffers, hash_words, mix, slices

#: Positions of a chunk; one of them may differ, so each chunk gives this many keys.
CHUNK = 5
#: Bits kept of each minimum.
BITS = 16
#: Members and text bytes of a block of a hub's group; larger groups are compared block by block.
BLOCK_MEMBERS, BLOCK_BYTES = 2048, 4 << 20
#: Text bytes of whole groups compared at once.
CHUNK_BYTES = 2 << 20


def n_chunks(percent: int, miss: float = 1e-6) -> int:
    """Chunks so that a pair at the threshold has no chunk with one error at most with probability ``miss``."""
    same = percent / 100
    bad = 1 - same**CHUNK - CHUNK * (1 - same) * same ** (CHUNK - 1)
    return ceil(log(miss) / log(bad))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's runs of ``width`` words; a shorter text is one run."""
    words, at = hash_words(data, offsets, WHITE_SPACE)
    with np.errstate(over="ignore"):
        n = len(words) - width + 1
        runs = np.zeros(max(n, 0), np.uint64)
        if n > 0:
            for k in range(width):
                runs = runs * np.uint64(0x9E3779B97F4A7C15) + words[k : n + k]
            runs = mix(runs)
        sets = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if b - a >= width:
                sets.append(np.unique(runs[a : b - width + 1]))
            elif b > a:
                h = np.uint64(b - a)
                for w in words[a:b]:
                    h = h * np.uint64(0xD1342543DE82EF95) + w
                sets.append(mix(np.array([h], np.uint64)))
            else:
                sets.append(np.zeros(0, np.uint64))
    return sets


def _minima(hashes: np.ndarray, times: np.ndarray, plus: np.ndarray) -> np.ndarray:
    """The low bits of the minimum of each hash function over a set."""
    best = np.full(len(times), np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(hashes), 4096):
        best = np.minimum(best, (hashes[None, a : a + 4096] * times[:, None] + plus[:, None]).min(axis=1))
    return (mix(best) & np.uint64((1 << BITS) - 1)).astype("<u2")


def _sign(text: str, columns: list[str], width: int, positions: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(5)
        times = rng.integers(0, 1 << 63, positions, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        plus = rng.integers(0, 1 << 63, positions, dtype=np.uint64)
        for batch in slices(batches, text):
            sets = shingle_sets(*buffers(batch.column(text)), width)
            sigs = [_minima(s, times, plus).tobytes() if len(s) else None for s in sets]
            digests = [
                np.array([mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)]).tobytes() if len(s) else None for s in sets
            ]
            sizes = pa.array([len(s) for s in sets], pa.int64())
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, sizes, pa.array(sigs, pa.binary()), pa.array(digests, pa.binary())], [*columns, "_n", "_sig", "_set"]
            )

    return sign


def _index(chunks: int):
    """All keys of a class: of each chunk the positions but one."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left_out = np.array([[k for k in range(CHUNK) if k != j] for j in range(CHUNK)])
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sigs = np.frombuffer(b"".join(batch.column("_sig").to_pylist()), "<u2").reshape(n, chunks, CHUNK).astype(np.uint64)
            salt = np.arange(chunks * CHUNK, dtype=np.uint64).reshape(chunks, CHUNK) + np.uint64(1)
            parts = sigs[:, :, left_out]  # class, chunk, position left out, the others
            keys = mix(np.broadcast_to(salt * np.uint64(0x9E3779B97F4A7C15), parts.shape[:3]).copy())
            for k in range(CHUNK - 1):
                keys = mix(keys * np.uint64(0xD1342543DE82EF95) + parts[..., k])
            per = chunks * CHUNK
            each = pa.array(np.repeat(np.arange(n), per))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.reshape(-1).view(np.int64)), *[batch.column(c).take(each) for c in ("cls", "copies")]], ["key", "cls", "copies"]
            )

    return index


def group_links(sets: list[np.ndarray], asks: np.ndarray, known: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect the members of a group exactly as all their links do.

    Only pairs of which one member ``asks`` are looked at, and members with one ``known``
    component are connected already.

    Sets are coded by which hashes of the first (the hub) they hold, as bits, and how many others.
    The others that two sets share are at most those of the smaller, which bounds their
    similarity; only pairs of different components under which the bound reaches the threshold
    are compared in full.
    """
    n = len(sets)
    roots = np.unique(known, return_index=True)[1][np.unique(known, return_inverse=True)[1]]
    least = roots.tolist()

    def find(x: int) -> int:
        while least[x] != x:
            least[x] = least[least[x]]
            x = least[x]
        return x

    sizes = np.array([len(s) for s in sets])
    bits = np.zeros((n, -(-len(sets[0]) // 8)), np.uint8)
    for k, s in enumerate(sets):
        at = np.minimum(np.searchsorted(s, sets[0]), len(s) - 1)
        bits[k] = np.packbits(s[at] == sets[0])
    inside = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    outside = sizes - inside
    found = []
    for i in range(n - 1):
        rest = slice(i + 1, n)
        common = np.bitwise_count(bits[i] & bits[rest]).sum(axis=1, dtype=np.int64) + np.minimum(outside[i], outside[rest])
        possible = (100 * common >= percent * (sizes[i] + sizes[rest] - common)) & (roots[rest] != roots[i])
        if not asks[i]:
            possible &= asks[rest]
        for j in (np.flatnonzero(possible) + i + 1).tolist():
            a, b = find(i), find(j)
            if a == b:
                continue
            same = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * same >= percent * (sizes[i] + sizes[j] - same):
                found.append((i, j))
                least[max(a, b)] = min(a, b)
                roots[roots == max(a, b)] = min(a, b)
    return found


def _link(percent: int, width: int):
    """Links of groups that come ordered by group, the hub before the other members."""

    def settle(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        chunk = pa.Table.from_batches(rows).combine_chunks()
        group, cls, asks, known = (chunk.column(c).to_numpy(zero_copy_only=False) for c in ("group", "cls", "asks", "known"))
        # Equal rows of the input bring a class twice, and so do both sides of a group; the one that asks comes first.
        once = np.ones(len(cls), bool)
        once[1:] = (group[1:] != group[:-1]) | (cls[1:] != cls[:-1])
        group, cls, asks, known = group[once], cls[once], asks[once], known[once]
        sets = shingle_sets(*buffers(chunk.column("_text").filter(pa.array(once)).combine_chunks()), width)
        cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1])).tolist()
        a, b = [], []
        for x, y in zip(cuts, [*cuts[1:], len(cls)], strict=True):
            for i, j in group_links(sets[x:y], asks[x:y], known[x:y], percent):
                a.append(cls[x + i])
                b.append(cls[x + j])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches, "_text", CHUNK_BYTES):
            if held and size >= CHUNK_BYTES:
                same = int((batch.column("group").to_numpy() == held[-1].column("group")[-1].as_py()).cumprod().sum())
                if same:
                    held.append(batch.slice(0, same))
                    batch = batch.slice(same)
                if batch.num_rows:
                    yield settle(held)
                    held, size = [], 0
            if batch.num_rows:
                held.append(batch)
                size += pa.compute.sum(pa.compute.binary_length(batch.column("_text"))).as_py()
        if held:
            yield settle(held)

    return link


def _members(index: DataFrame, classes: DataFrame) -> DataFrame:
    """Each bucket's hub, the class with the most copies, with all members: (hub, class) once,
    with the block of the hub's members they are dealt to and how many blocks there are."""
    hubs = index.groupBy("key").agg(F.max(F.struct("copies", (-F.col("cls")).alias("_neg"))).alias("h"))
    pairs = index.join(hubs.select("key", (-F.col("h._neg")).alias("hub")), "key").select("hub", "cls").distinct()
    members = pairs.join(classes.select("cls", "_rep", "_hash", "_bytes"), "cls")
    sizes = members.groupBy("hub").agg(_blocks().alias("blocks"))
    return members.join(sizes, "hub").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")))


def _blocks() -> Column:
    return F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS), F.ceil(F.sum("_bytes") / BLOCK_BYTES))


def _numbers(n: str) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.col(n) - 1)


_MET = ["hub", "cls", "_rep", "_hash", "group", "asks", "known"]


def _own_blocks(members: DataFrame) -> DataFrame:
    """Members meet within their block; the hub is in all of them."""
    where = F.when(F.col("cls") == F.col("hub"), _numbers("blocks")).otherwise(F.array("block"))
    met = members.withColumn("at", F.explode(where))
    return met.withColumns({"group": F.xxhash64("hub", "at"), "asks": F.lit(True), "known": F.col("cls")}).select(*_MET)


def _strays(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members of several blocks that own blocks didn't connect to their hub, with all members.

    Two members can have a link that was not looked at only if one of them isn't connected to
    the hub yet. Those are dealt to blocks of their own, and each of these meets each block of
    members; with few of them, a member moves a few times however many blocks its hub has.
    """
    large = members.where("blocks > 1")
    names = large.select(F.col("cls").alias("a")).distinct()
    inside = links.join(names, "a", "left_semi").join(names.withColumnRenamed("a", "b"), "b", "left_semi").select("a", "b")
    components = connected_components(inside).select(F.col("node").alias("cls"), "component")
    joined = large.join(components, "cls", "left").withColumn("known", F.coalesce("component", "cls"))
    joined = written(joined.drop("component"), "large")
    homes = joined.where("cls = hub").select("hub", F.col("known").alias("_home"))
    strays = joined.join(homes, "hub").where("known <> _home").drop("_home")
    counts = strays.groupBy("hub").agg(_blocks().alias("strays"))
    asking = strays.join(counts, "hub").withColumns({"s": F.pmod(F.xxhash64("cls", F.lit(1)), F.col("strays")), "at": F.explode(_numbers("blocks"))})
    hub_too = F.when(F.col("cls") == F.col("hub"), _numbers("blocks")).otherwise(F.array("block"))
    others = joined.join(counts, "hub").withColumn("at", F.explode(hub_too)).withColumn("s", F.explode(_numbers("strays")))
    both = asking.withColumn("asks", F.lit(True)).unionByName(others.withColumn("asks", F.lit(False)))
    return both.withColumn("group", F.xxhash64("hub", "at", "s")).select(*_MET)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` with ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked if their sets of ``width``-word shingles have a Jaccard similarity of
    ``percent`` / 100 at least; components are named by their least id, whose document is kept.

    Documents with equal sets form one class. A class has a signature of 16-bit minima in chunks
    of five; each chunk gives a key for every position left out, so two signatures that differ
    in fewer than twice as many positions as there are chunks share a key for certain
    (pigeonhole). The number of chunks makes a pair at the threshold share no key with
    probability 1e-6. The members of all buckets with one hub form a group; in a task, a group
    gives only the links that connect its members, so no pairs are written out. Large groups are
    dealt to blocks, and only members that their block doesn't connect to the hub meet the other
    blocks. Every link is confirmed on the full sets.

    A text without words (or null) has an empty set and no link. A null id is linked with
    nothing, has a null component and is kept. Rows that share an id are one node: their links
    count together. Columns of ``docs`` named like the added ones are replaced; names that begin
    with an underscore are reserved.
    """
    docs = docs.drop("n_shingles", "component_id", "kept")
    chunks = n_chunks(percent)
    positions = chunks * CHUNK
    source = docs.select(F.col(ident).alias("_id"), F.col(text).alias("_text"), F.xxhash64(text).alias("_text_hash"))
    sized = source.withColumn("_bytes", F.octet_length("_text"))
    schema = "_id long, _text_hash long, _bytes int, _n long, _sig binary, _set binary"
    signed = written(sized.mapInArrow(_sign("_text", ["_id", "_text_hash", "_bytes"], width, positions), schema), "signed")
    full = signed.where("_n > 0 and _id is not null")
    grouped = full.groupBy("_set").agg(
        F.min(F.struct("_id", "_text_hash", "_bytes")).alias("_r"), F.count(F.lit(1)).alias("copies"), F.first("_sig").alias("_sig")
    )
    classes = written(
        grouped.select("_set", F.col("_r._id").alias("_rep"), F.col("_r._text_hash").alias("_hash"), F.col("_r._bytes").alias("_bytes"), "copies", "_sig").withColumn(
            "cls", F.monotonically_increasing_id()
        ),
        "classes",
    )
    keys = classes.select("cls", "copies", "_sig").mapInArrow(_index(chunks), "key long, cls long, copies long")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("_m")).where("_m > 1").select("key")
    index = written(keys.join(shared, "key"), "index")
    members = written(_members(index, classes), "hubs")

    def linked(groups: DataFrame, members: DataFrame) -> DataFrame:
        # Only texts of members are moved, and few others.
        wanted = members.select(F.col("_rep").alias("_id"), F.col("_hash").alias("_text_hash"))
        texts = maybe_in(source, wanted, "_id, _text_hash", members.count())
        with_text = texts.join(groups, (F.col("_id") == F.col("_rep")) & (F.col("_text_hash") == F.col("_hash")))
        # The hub stands first in its groups, and of one class the row that asks.
        ordered = with_text.repartition("group").sortWithinPartitions("group", F.col("cls") != F.col("hub"), "cls", F.col("asks").desc())
        met = ordered.select("group", "cls", "asks", "known", "_text")
        return written(met.mapInArrow(_link(percent, width), "a long, b long"), "links")

    links = linked(_own_blocks(members), members)
    if members.where("blocks > 1").limit(1).count():
        links = links.unionByName(linked(_strays(members, links), members.where("blocks > 1")))
    of_class = written(full.join(classes.select("_set", "cls"), "_set").select("_id", "cls"), "members")
    # Rows that share an id connect their classes.
    several = of_class.groupBy("_id").agg(F.min("cls").alias("a"), F.max("cls").alias("_hi")).where("a < _hi")
    links = links.unionByName(several.join(of_class, "_id").select("a", F.col("cls").alias("b")))
    components = connected_components(links).select(F.col("node").alias("cls"), "component")
    named = classes.select("cls", "_set", "_rep").join(components, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    least = named.groupBy("component").agg(F.min("_rep").alias("_least"))
    by_set = named.join(least, "component").select("_set", "_least")
    rows = signed.join(by_set, "_set", "left").select("_id", "_text_hash", "_n", F.coalesce("_least", "_id").alias("_least"))
    # One row per id and text: equal rows get the same values.
    values = rows.groupBy("_id", "_text_hash").agg(F.min("_n").alias("n_shingles"), F.min("_least").alias("component_id"))
    keyed = docs.withColumn("_text_hash", F.xxhash64(text)).withColumn("_id", F.col(ident))
    joined = keyed.join(values, keyed["_id"].eqNullSafe(values["_id"]) & (keyed["_text_hash"] == values["_text_hash"]))
    kept = F.coalesce(F.col(ident) == F.col("component_id"), F.lit(True))
    return joined.select(*[keyed[c] for c in docs.columns], "n_shingles", F.when(F.col(ident).isNotNull(), F.col("component_id")).alias("component_id"), kept.alias("kept"))
