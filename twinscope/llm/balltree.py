"""Ranked lexical search: exact largest inner products by ball trees over sparse document vectors."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinscope.llm.components import written
from twinscope.llm.textbytes import ALPHANUMERIC, buffers, hash_words, slices

#: Items searched in one pass over the documents, and their distinct terms at most.
ITEMS_PER_PASS, TERMS_PER_PASS = 2000, 1 << 16
#: Bytes of the matrix behind one tree (documents times the terms of the pass).
TREE_BYTES = 64 << 20
#: Documents of a tree at most, and of a leaf.
TREE_DOCS, LEAF_DOCS = 4096, 16
#: Terms of similar weight that share a radius.
BAND = 4
#: Integers up to here are exact in doubles, sums in any order included.
EXACT = 1 << 53
#: The parts of a score.
NUMERATOR, TF_FACTOR, M_FACTOR = 1_000_000_000, 1000, 12


# --- terms and weights --------------------------------------------------------------------------


def term_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text its distinct terms: (text, term hash, occurrences), and all terms per text.

    Terms are runs of ASCII letters and digits and of characters above 127, A-Z lower-cased;
    they are told apart by a 64-bit hash.
    """
    data, offsets = buffers(texts)
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, np.zeros(len(offsets) - 1, np.int64)
    words, first = hash_words(data, offsets, ALPHANUMERIC)
    n = np.diff(first)
    owner = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((words, owner))
    owner, words = owner[order], words[order]
    new = np.ones(len(words), bool)
    new[1:] = (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(new)
    return owner[starts], words[starts], np.diff(np.append(starts, len(words))), n


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """What an occurrence count adds to a score for each unit of term weight; all terms of a
    document count towards its length ``n``."""
    # Python integers where 25 n N could pass 64 bits.
    if 25 * int(n.max(initial=0)) * n_docs < 1 << 63:
        m = 75 + (25 * n * n_docs) // total
    else:
        m = np.array([75 + (25 * int(x) * n_docs) // total for x in n], np.int64)
    return (NUMERATOR * tf) // (TF_FACTOR * tf + M_FACTOR * m)


# --- the tree -----------------------------------------------------------------------------------


class Ball:
    """Nodes of a tree over the rows of ``points``, which it puts in tree order in place.

    Node k holds rows ``lo[k]`` to ``hi[k]`` around ``centre[k]``; ``child[k]`` is its first child
    (the second follows) or -1 at a leaf. ``order`` gives for each row the place it came from.
    One radius over thousands of terms bounds little, so terms are taken in bands of ``BAND``
    neighbours and each node has a radius in each band: rows lie in the product of these balls.
    A leaf's radii come from its rows, a parent's from its children by the triangle inequality.

    Points are float32 whole numbers or these times powers of two, taken as exact. Radii are
    rounded up by more than the error of their float32 sums.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF_DOCS):
        self.order = np.arange(len(points))
        self.lo, self.hi, self.child, centres = [0], [len(points)], [-1], []
        k = 0
        while k < len(self.lo):
            a, b = self.lo[k], self.hi[k]
            rows = points[a:b]
            centre = rows.mean(axis=0, dtype=np.float32)
            centres.append(centre)
            gap = self._squares(rows, centre)
            if b - a > leaf and gap.max() > 0:
                # Two far points make the axis; the middle along it makes two halves.
                left = rows[gap.argmax()]
                right = rows[self._squares(rows, left).argmax()]
                along = np.argsort(rows @ (right - left), kind="stable")
                points[a:b] = rows[along]
                self.order[a:b] = self.order[a:b][along]
                middle = (a + b) // 2
                self.child[k] = len(self.lo)
                self.lo += [a, middle]
                self.hi += [middle, b]
                self.child += [-1, -1]
            k += 1
        self.centre = np.array(centres)
        self.radius = np.zeros((len(centres), -(-points.shape[1] // BAND)), np.float32)
        for k in reversed(range(len(centres))):
            if self.child[k] < 0:
                self.radius[k] = self._bands(points[self.lo[k] : self.hi[k]] - self.centre[k]).max(axis=0)
            else:
                pair = slice(self.child[k], self.child[k] + 2)
                self.radius[k] = ((self.radius[pair] + self._bands(self.centre[pair] - self.centre[k])) * np.float32(1 + 2.0**-20)).max(axis=0)

    @staticmethod
    def _bands(gaps: np.ndarray) -> np.ndarray:
        """Lengths of the parts of each row, rounded up."""
        sums = np.add.reduceat(gaps * gaps, np.arange(0, gaps.shape[1], BAND), axis=1)
        return np.sqrt(sums) * np.float32(1 + 2.0**-19)

    @staticmethod
    def _squares(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
        out = np.empty(len(rows), np.float32)
        for at in range(0, len(rows), 256):
            d = rows[at : at + 256] - point
            out[at : at + 256] = np.einsum("ij,ij->i", d, d)
        return out

    def bounds(self, terms: np.ndarray, values: np.ndarray) -> np.ndarray:
        """For each node an upper bound of its rows' inner products with a sparse query (rising
        terms), rounded up: the centre's product, and in each band radius times query length."""
        if not len(terms):
            return np.zeros(len(self.lo))
        up = 1 + (len(terms) + 16) * 2.0**-48
        bands = terms // BAND
        first = np.flatnonzero(np.diff(bands, prepend=-1))
        lengths = np.sqrt(np.add.reduceat(values * values, first)) * up
        middle = self.centre[:, terms].astype(np.float64) @ values
        return (middle + self.radius[:, bands[first]].astype(np.float64) @ lengths) * up


def best_first(tree: Ball, bounds: np.ndarray, score, name, keep: list, top: int) -> int:
    """Add a query's best rows to the heap ``keep`` of (score, id reversed, row); returns leaves scored.

    ``score`` gives the scores of a range of rows, ``name`` a row's place and id. Subtrees are
    taken by falling bound; one whose bound is below the worst of ``top`` kept rows ends the
    search, as all others are below too. An equal bound goes on: ties are by id.
    """
    leaves, queue = 0, [(-float(bounds[0]), 0)]
    while queue:
        bound, node = heapq.heappop(queue)
        if len(keep) == top and -bound < keep[0][0]:
            break
        if tree.child[node] >= 0:
            for child in (tree.child[node], tree.child[node] + 1):
                heapq.heappush(queue, (-float(bounds[child]), child))
            continue
        leaves += 1
        got = score(tree.lo[node], tree.hi[node])
        least = keep[0][0] if len(keep) == top else 1
        for k in np.flatnonzero(got >= least).tolist():
            row, ident = name(tree.lo[node] + k)
            entry = (int(got[k]), _Least(ident), row)
            if len(keep) < top:
                heapq.heappush(keep, entry)
            elif entry[:2] > keep[0][:2]:
                heapq.heapreplace(keep, entry)
    return leaves


# --- tasks --------------------------------------------------------------------------------------


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        owner, term, count, _ = term_counts(batch.column("text"))
        # One row per item.
        cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x)) for x in (term.view(np.int64), count)]
        yield pa.RecordBatch.from_arrays([batch.column("item"), *lists], ["item", "terms", "counts"])


def _forward(vocabulary, columns: list[str]):
    """Of each document with terms: how many, and places and counts of those that items hold."""

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in slices(batches, "_text"):
            owner, term, count, n = term_counts(batch.column("_text"))
            place = np.searchsorted(known, term)
            place[place == len(known)] = 0
            wanted = known[place] == term if len(known) else np.zeros(len(term), bool)
            cuts = np.searchsorted(owner[wanted], np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x[wanted].astype(np.int32))) for x in (place, count)]
            out = pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(n), *lists], [*columns, "_n", "_terms", "_tf"])
            yield out.filter(pa.array(n > 0))

    return forward


def _frequencies(size: int):
    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("_terms").flatten().to_numpy(), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["term", "df"])

    return frequencies


def _search(shipped, id_column: str, top: int, n_docs: int, total: int, tree_docs: int):
    """The best documents of a task for each item, from one tree after the other.

    What earlier trees kept prunes later ones.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = shipped.value
        # Terms of similar weight become neighbours.
        rising = np.argsort(weights, kind="stable")
        moved = np.argsort(rising)
        weights = weights[rising]
        queries = [(np.sort(moved[t]), v[np.argsort(moved[t])]) for t, v in queries]
        # Scaled by powers of two only, so both sides of a product stay exact.
        scale = np.exp2(np.round(np.log2(np.maximum(weights, 1)) / 2))
        back = (1 / scale).astype(np.float32)
        sums = [int(v.sum()) * (NUMERATOR // TF_FACTOR) < EXACT for _, v in queries]
        keep: list[list] = [[] for _ in queries]
        ids, stats = [], np.zeros(2, np.int64)

        def one_tree(rows: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(rows).combine_chunks()
            places, tf = (table.column(c).combine_chunks() for c in ("_terms", "_tf"))
            owner = np.repeat(np.arange(len(places)), pa.compute.list_value_length(places).to_numpy())
            places, tf = places.flatten().to_numpy(), tf.flatten().to_numpy().astype(np.int64)
            n = table.column("_n").to_numpy()
            vectors = np.zeros((table.num_rows, len(weights)), np.float32)
            places = moved[places]
            vectors[owner, places] = impacts(tf, n[owner], n_docs, total) * scale[places]
            tree = Ball(vectors)
            first = len(ids)
            ids.extend(table.column(id_column).to_pylist())

            def name(row: int) -> tuple:
                at = first + int(tree.order[row])
                return at, ids[at]

            for (terms, values), exact, kept in zip(queries, sums, keep, strict=True):

                def score(lo: int, hi: int, terms=terms, values=values, exact=exact) -> np.ndarray:
                    part = vectors[lo:hi, terms] * back[terms]
                    if exact:
                        return (part.astype(np.float64) @ values).astype(np.int64)
                    return part.astype(np.int64) @ values.astype(np.int64)

                stats[0] += best_first(tree, tree.bounds(terms, values / scale[terms]), score, name, kept, top)
            stats[1] += len(queries) * sum(c < 0 for c in tree.child)
            # Ids that no item keeps are let go.
            used = sorted({e[2] for kept in keep for e in kept})
            new = {row: k for k, row in enumerate(used)}
            ids[:] = [ids[row] for row in used]
            for q, kept in enumerate(keep):
                keep[q] = [(s, i, new[row]) for s, i, row in kept]

        held, size, kind = [], 0, None
        for batch in batches:
            kind = batch.schema.field(id_column).type
            while batch.num_rows:
                part = batch.slice(0, tree_docs - size)
                batch = batch.slice(part.num_rows)
                held.append(part)
                size += part.num_rows
                if size == tree_docs:
                    one_tree(held)
                    held, size = [], 0
        if held:
            one_tree(held)
        out = [(q, ids[row], s) for q, kept in enumerate(keep) for s, _, row in kept]
        if out:
            item, doc, s = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item), pa.array(doc, kind), pa.array(s, pa.int64()), pa.array([int(stats[0])] * len(s)), pa.array([int(stats[1])] * len(s))],
                ["_item", id_column, "score", "_leaves", "_all_leaves"],
            )

    return search


class _Least:
    """An id in reverse order, so that the heap drops the greatest of equal scores; null is least."""

    __slots__ = ("ident",)

    def __init__(self, ident):
        self.ident = ident

    def __eq__(self, other) -> bool:
        return self.ident == other.ident

    def __lt__(self, other) -> bool:
        if self.ident is None or other.ident is None:
            return self.ident is not None and other.ident is None
        return self.ident > other.ident


def search(docs: DataFrame, items: DataFrame, top: int = 20, text: str = "text", ident: str = "doc_id", item: str = "item_id", items_per_pass: int = ITEMS_PER_PASS, with_work: bool = False) -> DataFrame:
    """The ``top`` documents of each item by score: item id, ``rank``, document id, ``score``.

    The items are the stated query set and are searched in blocks of ``items_per_pass`` rows or
    of ``TERMS_PER_PASS`` terms, each against all documents: only what items ask for is kept of
    a document's vector. Pass 1 writes those vectors, and document frequencies, lengths and
    counts are summed over all documents. In pass 2 each task puts its vectors in ball trees,
    bounds every subtree by centre and radius, rounded up, and searches best-first; leaves are
    scored in integers. A task sends at most ``top`` rows for an item to the final ranking.

    Scores are as stated in ``impacts`` and ``term_weight``; only those above 0 count, equal ones
    are ranked by id (null first), equal rows in any order. A null or empty text has no terms, so
    it is never found, and an item without terms finds nothing. Repeated rows of either table
    count each; each item row has ranks of its own. Other columns of ``docs`` are not looked at.
    ``with_work`` adds leaves scored and leaves there were, by the task that found the row.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(ident).alias(ident), F.col(text).alias("_text"))
    asked = items.select(F.col(item).alias("item"), F.col(text).alias("text"))
    kind = asked.schema["item"].dataType
    found = asked.mapInArrow(_items, f"item {kind.simpleString()}, terms array<long>, counts array<long>")
    rows, results = found.toLocalIterator(), None
    held = next(rows, None)
    while held is not None:
        block, size = [held], len(held.terms)
        for held in rows:
            if len(block) == items_per_pass or size + len(held.terms) > TERMS_PER_PASS:
                break
            block.append(held)
            size += len(held.terms)
        else:
            held = None
        part = _search_block(source, block, top, ident, kind, item)
        results = part if results is None else results.unionByName(part)
    if results is None:
        empty = f"`{item}` {kind.simpleString()}, rank int, `{ident}` {docs.schema[ident].dataType.simpleString()}, score long, leaves long, all_leaves long"
        results = spark.createDataFrame([], empty)
    return results if with_work else results.drop("leaves", "all_leaves")


def _search_block(source: DataFrame, block: list, top: int, ident: str, kind, item: str) -> DataFrame:
    spark = source.sparkSession
    vocabulary = np.unique(np.array([t for r in block for t in r.terms], np.int64).view(np.uint64))
    vectors = source.mapInArrow(_forward(spark.sparkContext.broadcast(vocabulary), [ident]), source.select(ident, F.lit(0).cast("long").alias("_n"), F.array().cast("array<int>").alias("_terms"), F.array().cast("array<int>").alias("_tf")).schema)
    vectors = written(vectors, "vectors")
    n_docs, total = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for row in vectors.mapInArrow(_frequencies(len(vocabulary)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[row.term] = row.df
    weights = np.array([term_weight(n_docs, int(x)) for x in df], np.float64)
    queries = []
    for row in block:
        at = np.searchsorted(vocabulary, np.array(row.terms, np.int64).view(np.uint64))
        queries.append((at, weights[at] * np.array(row.counts, np.float64)))
    tree_docs = int(np.clip(TREE_BYTES // (4 * max(len(vocabulary), 1)), LEAF_DOCS, TREE_DOCS))
    shipped = spark.sparkContext.broadcast((queries, weights))
    hits = vectors.where(F.size("_terms") > 0)
    schema = source.select(F.lit(0).cast("long").alias("_item"), ident, *[F.lit(0).cast("long").alias(c) for c in ("score", "_leaves", "_all_leaves")]).schema
    best = hits.mapInArrow(_search(shipped, ident, top, n_docs, total, tree_docs), schema)
    order = Window.partitionBy("_item").orderBy(F.col("score").desc(), F.col(ident))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(k, r.item) for k, r in enumerate(block)], f"_item long, _name {kind.simpleString()}")
    # One row per item of the block.
    return ranked.join(F.broadcast(names), "_item").select(
        F.col("_name").alias(item), "rank", F.col(ident), "score", F.col("_leaves").alias("leaves"), F.col("_all_leaves").alias("all_leaves")
    )
