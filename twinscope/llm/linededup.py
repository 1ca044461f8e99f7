"""Line dedup by a deletion-neighbourhood join over words. Native."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinscope.llm.components import written

#: Hash bits of one word; sums of this many words can't leave 64 bits: 2**23.
WORD_BITS = 40
#: Bits for each wanted key in the map that keeps most other rows from being moved, and its most
#: bits, in rows of 64; under ``LEAST_BITS`` a key it would let most rows through and isn't made.
KEY_BITS, LEAST_BITS, MOST_BITS = 8, 2, 1 << 26


def normalised(line: Column) -> Column:
    """Lower case, white space collapsed: what lines are compared by."""
    return F.trim(F.regexp_replace(F.lower(line), r"\s+", " "))


def _word_hash(seed: int, place: Column, word: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), place, word), 64 - WORD_BITS)


def _half_keys(norm: Column, n: Column) -> Column:
    """Hashes of a beginning and an end of a line of n words: lines one word edit apart share one.

    An edit lies after the first h words or before the last h, for any h up to half of what is
    left without the edited word; as lengths may differ by one, the h of one word less is used too.
    """
    half = lambda k: F.floor((n - k) / 2).cast("int")
    begin = lambda h: F.hash(h, F.call_function("substring_index", norm, F.lit(" "), h))
    end = lambda h: F.hash(-h, F.call_function("substring_index", norm, F.lit(" "), -h))
    return F.array(begin(half(1)), end(half(1)), F.when(n % 2 == 1, begin(half(2))), F.when(n % 2 == 1, end(half(2))))


def _words(norm: Column) -> Column:
    return F.length(norm) - F.length(F.replace(norm, F.lit(" "))) + 1


def line_table(docs: DataFrame, text: str, ident: str, min_words: int, min_edit_words: int) -> DataFrame:
    """One narrow row per line of ``min_words`` words at least: two hashes, place, halves' hashes.

    All is computed inside one generator, so each line is normalised once.
    """
    named = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("line"), normalised(x).alias("norm")))
    counted = F.transform(named, lambda x: F.struct(x["line"].alias("line"), x["norm"].alias("norm"), _words(x["norm"]).alias("n")))
    long_enough = F.filter(counted, lambda x: (x["n"] >= min_words) & (x["norm"] != ""))
    keyed = F.transform(
        long_enough,
        lambda x: F.struct(
            x["line"].alias("line"),
            F.xxhash64(F.lit(2), x["norm"]).alias("k1"),
            F.xxhash64(F.lit(3), x["norm"]).alias("k2"),
            F.when(x["n"] >= min_edit_words, _half_keys(x["norm"], x["n"])).alias("h"),
        ),
    )
    lines = docs.select(F.col(ident).alias("id"), F.xxhash64(text).alias("body"), F.explode(keyed).alias("x"))
    return lines.select(F.struct("id", "body", "x.line").alias("place"), "x.k1", "x.k2", *[F.get("x.h", F.lit(i)).alias(f"h{i}") for i in range(4)])


def maybe_in(df: DataFrame, wanted: DataFrame, key: str, n: int, outside: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is among the ``n`` wanted ones, and some others, as long as a map
    of those keys is small enough to be sent to all tasks; ``outside`` gives all rows it leaves out."""
    bits = min(1 << max(10, (KEY_BITS * n - 1).bit_length()), MOST_BITS)
    if LEAST_BITS * n > bits or not bits:
        return df.where(F.lit(not outside))
    row, at = f"pmod(xxhash64({key}), {bits}L) div 64", f"cast(pmod(pmod(xxhash64({key}), {bits}L), 64) as int)"
    ones = wanted.select(F.expr(row).alias("_row"), F.expr(f"shiftleft(1L, {at})").alias("_one"))
    rows = ones.groupBy("_row").agg(F.bit_or("_one").alias("_bits"))
    # MOST_BITS / 64 rows at most.
    met = df.withColumns({"_row": F.expr(row), "_at": F.expr(at)}).join(F.broadcast(rows), "_row", "left" if outside else "inner")
    inside = F.expr("coalesce(shiftrightunsigned(_bits, _at) & 1L, 0L)") == 1
    return met.where(~inside if outside else inside).select(*df.columns)


def _texts_of(docs: DataFrame, places: DataFrame, text: str, ident: str) -> DataFrame:
    """``norm`` of the lines at ``first``; only documents that may hold one are moved."""
    # At most as many as the document has lines.
    wanted = places.groupBy(F.col("first.id").alias("id"), F.col("first.body").alias("body")).agg(
        F.collect_list(F.struct(F.col("first.line").alias("line"), "k1", "k2", "first", "c", "begins", "ends")).alias("wanted")
    )
    texts = docs.select(F.col(ident).alias("_id"), F.xxhash64(text).alias("body"), F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    texts = maybe_in(texts, wanted, "body", places.count()).withColumnRenamed("body", "_body")
    found = texts.join(wanted, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_body") == F.col("body")))
    split = found.select("wanted", F.split("_text", "\n").alias("_lines"))
    each = F.transform("wanted", lambda w: F.struct(*[w[c].alias(c) for c in ("k1", "k2", "first", "c", "begins", "ends")], normalised(F.get("_lines", w["line"])).alias("norm")))
    # Equal rows of the input have equal places: one of them is enough.
    return split.select(F.explode(each).alias("x")).select("x.*").dropDuplicates(["c"])


def _variants(candidates: DataFrame) -> DataFrame:
    """The deletion neighbourhood of each line: what stands before and after each word, and after
    each gap, as one hash. Lines that share a variant are one word edit apart at most: a word
    replaced, put in or left out. Sums of word hashes by place from either end make each variant
    one addition; they run over the line's words by window, as a line may be very long.

    Where only beginnings are shared, the edit lies in the second half, and in the first where
    only ends are; just the variants of that half are needed.
    """
    split = candidates.select("c", "begins", "ends", F.split("norm", " ").alias("w"))
    words = split.select("c", "begins", "ends", F.size("w").alias("n"), F.posexplode("w").alias("at", "word"))
    hashed = words.select(
        "c",
        "begins",
        "ends",
        "n",
        "at",
        _word_hash(4, F.col("at"), F.col("word")).alias("front"),
        _word_hash(5, F.col("n") - F.col("at"), F.col("word")).alias("back"),
    )
    line = Window.partitionBy("c").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    sums = hashed.withColumns(
        {"so_far": F.sum("front").over(line), "rest": F.sum("back").over(Window.partitionBy("c")) - F.sum("back").over(line)}
    )
    needed = (F.col("begins") & (F.col("at") >= F.expr("(n - 2) div 2"))) | (F.col("ends") & (F.col("at") <= F.expr("(n - 1) div 2")))
    before, last = F.col("so_far") - F.col("front"), F.col("at") == F.col("n") - 1
    # The word left out; the gap before it; for the last word also the gap after it.
    gaps = F.array(
        F.xxhash64(before, "rest"),
        F.xxhash64(before, F.col("rest") + F.col("back")),
        F.when(last, F.xxhash64("so_far", F.lit(0).cast("long"))),
    )
    exploded = sums.where(needed).select("c", F.explode(gaps).alias("variant"))
    return exploded.where("variant is not null")


def _one_edit(a: Column, b: Column) -> Column:
    """Whether two word lists are one edit apart at most, by their common beginning and end."""
    longer, shorter = F.greatest(F.size(a), F.size(b)), F.least(F.size(a), F.size(b))
    same = lambda x, y: F.coalesce(F.nullif(F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), F.lit(False)), F.lit(0).cast("long")) - 1, F.size(x).cast("long"))
    return (longer - shorter <= 1) & (same(a, b) + same(F.reverse(a), F.reverse(b)) >= longer - 1)


def repeated_lines(docs: DataFrame, text: str = "text", ident: str = "doc_id", min_words: int = 1, min_edit_words: int = 10) -> DataFrame:
    """Places (id, body, line) of lines that an earlier line equals, or nearly equals.

    Lines are compared in lower case with white space collapsed; lines without words are no
    repeats. Equal lines count from ``min_words`` words on; lines one word edit apart (replaced, put in or left out) where both
    have ``min_edit_words`` at least. Earlier is the smaller id, then text hash and line number.
    """
    lines = written(line_table(docs, text, ident, min_words, min_edit_words), "lines")
    spread = [F.min("place").alias("first"), F.count(F.lit(1)).alias("n")]
    firsts = written(lines.groupBy("k1", "k2").agg(*spread), "firsts")
    # Lines that share a half with another line; h0 and h2 are beginnings, h1 and h3 ends.
    sides = F.array(*[F.struct(F.lit(i % 2).alias("side"), F.col(f"h{i}").alias("h")) for i in range(4)])
    half = lines.where("h0 is not null").select("k1", F.explode(sides).alias("x")).select("k1", "x.side", "x.h").where("h is not null")
    # Few lines stand twice, so equal lines are not counted out before.
    shared = half.groupBy("side", "h").agg(F.min("k1").alias("_a"), F.max("k1").alias("_b")).where("_a < _b").select("side", "h")
    wanted = half.join(shared, ["side", "h"]).groupBy("k1").agg(F.max(F.col("side") == 0).alias("begins"), F.max(F.col("side") == 1).alias("ends"))
    # Numbered in the order of their first places.
    near_ones = firsts.select("k1", "k2", "first").join(wanted, "k1").orderBy("first", "k1", "k2").withColumn("c", F.monotonically_increasing_id())
    near_ones = written(near_ones, "near")
    candidates = written(_texts_of(docs, near_ones, text, ident), "candidates")
    variants = written(_variants(candidates), "variants")
    earliest = variants.groupBy("variant").agg(F.min("c").alias("e"), F.max("c").alias("_last")).where("e < _last").select("variant", "e")
    pairs = variants.join(earliest, "variant").where("e < c").select("c", "e").distinct()
    texts = candidates.select("c", "k1", "k2", "norm")
    others = candidates.select(F.col("c").alias("e"), F.col("norm").alias("other"), F.col("first").alias("near"))
    both = pairs.join(texts, "c").join(others, "e")
    verified = both.where(_one_edit(F.split("norm", " "), F.split("other", " ")))
    near = verified.groupBy("k1", "k2").agg(F.min("near").alias("near"))
    least = firsts.join(near, ["k1", "k2"], "left").where("n > 1 or near is not null")
    least = written(least.select("k1", "k2", F.least("first", "near").alias("least")), "least")
    repeated = maybe_in(lines.select("place", "k1", "k2"), least, "k1", least.count())
    return repeated.join(least, ["k1", "k2"]).where(F.col("least") < F.col("place")).select("place.*")


def dedup_lines(docs: DataFrame, text: str = "text", ident: str = "doc_id", min_words: int = 1, min_edit_words: int = 10) -> DataFrame:
    """Rows of ``docs`` with repeated lines taken out of the text, and ``n_lines``, ``n_dropped``.

    See ``repeated_lines`` for which lines go; the earliest stays, and so do lines without words. A
    null text has no lines and stays null; an empty one is one empty line. Rows with one id and
    one text are one document and keep the same lines; a null id stands before all others.
    Columns named like the added ones are replaced; names that begin with an underscore are
    reserved.
    """
    docs = docs.drop("n_lines", "n_dropped")
    drops = repeated_lines(docs, text, ident, min_words, min_edit_words)
    # At most as many as the document has lines.
    drops = drops.groupBy("id", "body").agg(F.collect_set("line").alias("_drop"))
    keyed = docs.withColumn("_body", F.xxhash64(text))
    joined = keyed.join(drops, keyed[ident].eqNullSafe(drops["id"]) & (keyed["_body"] == drops["body"]), "left")
    split = joined.withColumn("_lines", F.split(text, "\n"))
    stay = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drop")))
    kept = F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n")
    out = F.when(F.col("_drop").isNull(), keyed[text]).otherwise(kept)
    return split.select(
        *[out.alias(text) if c == text else keyed[c] for c in docs.columns],
        F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"),
    )
