"""Document fingerprints: a Merkle tree over sentences, paragraphs and sections. Native."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A leaf is a sentence with what follows it, or a piece of at most this many characters of a longer one.
LEAF_CHARS = 64
LEAF = rf"(?s)[^.!?\n]{{0,{LEAF_CHARS}}}[.!?\n]+ ?|[^.!?\n]{{1,{LEAF_CHARS}}}"
#: A section ends with a paragraph whose digest begins with one of these digits (a quarter of them).
SECTION_ENDS = "0123"
#: Rows that a neighbour bucket holds on average, and the most buckets (their bounds are part of the plan).
ROWS_PER_BUCKET, MOST_BUCKETS = 2000, 4096


def leaves(text: Column) -> Column:
    """The leaves' codes in order: characters, a dash and twelve digits of the MD5 digest."""
    return F.transform(
        F.regexp_extract_all(text, F.lit(LEAF), F.lit(0)),
        lambda x: F.concat(F.length(x).cast("string"), F.lit("-"), F.substring(F.md5(x), 1, 12)),
    )


def paragraphs(text: Column) -> Column:
    """Digest of each paragraph (line) from its leaves."""
    return F.transform(F.split(text, "\n"), lambda p: F.sha2(F.array_join(leaves(p), " "), 256))


def sections(paras: Column) -> Column:
    """Digest of each section: paragraphs up to one that ends it, so an edit leaves later sections as they are."""
    joined = F.array_join(F.transform(paras, lambda d: F.concat(d, F.when(d.substr(1, 1).isin(*SECTION_ENDS), F.lit("|")).otherwise(F.lit(" ")))), "")
    return F.transform(F.filter(F.split(joined, r"\|"), lambda s: F.length(s) > 0), lambda s: F.sha2(s, 256))


def root(secs: Column) -> Column:
    return F.sha2(F.array_join(secs, " "), 256)


def with_tree(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``: a struct of root, sections, paragraphs and leaves of a text (null: empty)."""
    body = F.coalesce(F.col(text), F.lit(""))
    return (
        df.withColumn("_p", paragraphs(body))
        .withColumn("_s", sections(F.col("_p")))
        .withColumn(name, F.struct(root(F.col("_s")).alias("root"), F.col("_s").alias("sections"), F.col("_p").alias("paragraphs"), leaves(body).alias("leaves")))
        .drop("_p", "_s")
    )


def as_string(tree: Column) -> Column:
    """Root and leaves as one string, enough to compare two fingerprints."""
    return F.concat(tree["root"], F.lit(":"), F.array_join(tree["leaves"], ","))


def _weight(codes: Column) -> Column:
    return F.aggregate(codes, F.lit(0).cast("long"), lambda a, c: a + F.split_part(c, F.lit("-"), F.lit(1)).cast("long"))


def likeness(a: Column, b: Column) -> Column:
    """Share of characters in common distinct leaves (Dice), 1 for equal roots."""
    one, other = F.array_distinct(a["leaves"]), F.array_distinct(b["leaves"])
    both = _weight(F.array_intersect(one, other)) * 2.0
    return F.when(a["root"] == b["root"], F.lit(1.0)).otherwise(F.coalesce(F.try_divide(both, (_weight(one) + _weight(other)).cast("double")), F.lit(0.0)))


def edited_paragraphs(a: Column, b: Column) -> Column:
    """First paragraph that differs, and how many from there on differ in each text; null if roots are equal.

    Equal branches at the beginning and at the end are skipped, so the edit lies between.
    """
    one, other = a["paragraphs"], b["paragraphs"]
    differs = lambda x, y: F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), F.lit(False)) - 1
    head = differs(one, other)
    tail = F.least(differs(F.reverse(one), F.reverse(other)), F.least(F.size(one), F.size(other)) - head)
    found = F.struct(head.cast("int").alias("first"), (F.size(one) - head - tail).cast("int").alias("removed"), (F.size(other) - head - tail).cast("int").alias("added"))
    return F.when(a["root"] != b["root"], found)


def with_next(df: DataFrame, ident: str, values: dict[str, Column]) -> DataFrame:
    """Add ``values`` of the next row by ``ident`` (then by the values); after the last comes the first.

    Rows are dealt to buckets of neighbouring ids, whose bounds are ids of the table; the first
    rows of a bucket are also sent to the bucket before, so one shuffle brings each row next to
    its follower. A null id stands before all others.
    """
    summary = df.agg(F.count(F.lit(1)), F.count(ident), F.min(ident)).first()
    rows, known, least = summary
    n_buckets = min(max(1, -(-rows // ROWS_PER_BUCKET)), MOST_BUCKETS)
    share = [k / n_buckets for k in range(1, n_buckets)]
    bounds = sorted(set(df.approxQuantile(ident, share, 0.2 / n_buckets))) if known and share else []
    bounds = [int(b) for b in bounds if b > least]
    # Binary search in the bounds: how many are not over the id.
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    if bounds:
        array = F.array(*[F.lit(b).cast("long") for b in bounds])
        bucket = F.aggregate(
            F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when(F.get(array, at + s - 1) <= F.col(ident), at + s).otherwise(at)
        )
        bucket = F.coalesce(bucket, F.lit(0))
        before = F.when(F.array_contains(array, F.col(ident)), bucket - 1)
    else:
        bucket, before = F.lit(0), F.lit(None).cast("int")
    is_first = F.col(ident).isNull() if known < rows else F.col(ident).eqNullSafe(F.lit(least))
    homes = F.array(
        F.struct(bucket.alias("b"), F.lit(0).alias("role")),
        F.when(before.isNotNull(), F.struct(before.alias("b"), F.lit(1).alias("role"))),
        F.when(is_first, F.struct(F.lit(len(bounds)).alias("b"), F.lit(2).alias("role"))),
    )
    dealt = df.withColumn("_home", F.explode(F.filter(homes, lambda h: h.isNotNull()))).select("*", F.col("_home.b").alias("_b"), F.col("_home.role").alias("_role")).drop("_home")
    dealt = dealt.repartition("_b").withColumns({f"_own_{n}": v for n, v in values.items()})
    order = Window.partitionBy("_b").orderBy(F.col("_role") == 2, F.col(ident).asc_nulls_first(), *[F.col(f"_own_{n}") for n in values if n == "_order"], "_role")
    following = {n: F.lead(f"_own_{n}").over(order) for n in values}
    return dealt.withColumns(following).where("_role = 0").drop("_b", "_role", *[f"_own_{n}" for n in values])


def fingerprints(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` with ``tree`` (null text: as empty). Equal texts have equal trees."""
    return with_tree(docs.drop("tree"), text, "tree")


def compare_with_next(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Each text's tree, its edited text's, and likenesses.

    The edited text has its last quarter (rounded down, in code points) replaced by as many
    code points from the beginning of the next text. Columns: ``ident``, ``chars``, ``edited``,
    ``tree``, ``edited_tree``, ``near_edited``, ``near_next``, ``edit``. The next row is that of
    the next id; of rows with one id, or with none, the order is by text. A null text is empty;
    a table of one row is its own follower.
    """
    base = docs.select(F.col(ident).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    followed = with_next(base, "_id", {"_order": F.col("_text"), "_next": F.struct(F.col("_text").alias("text"), leaves(F.col("_text")).alias("leaves"))})
    n = F.length("_text")
    moved = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), n - moved), F.substring(F.col("_next.text"), F.lit(1), moved))
    out = with_tree(followed.withColumn("_edited", edited), "_text", "tree")
    out = with_tree(out, "_edited", "edited_tree")
    # Roots of texts are equal only where the texts are.
    next_tree = F.struct(F.when(F.col("_text") == F.col("_next.text"), F.col("tree.root")).otherwise(F.lit("")).alias("root"), F.col("_next.leaves").alias("leaves"))
    return out.select(
        F.col("_id").alias(ident),
        n.cast("long").alias("chars"),
        F.col("_edited").alias("edited"),
        "tree",
        "edited_tree",
        likeness(F.col("tree"), F.col("edited_tree")).alias("near_edited"),
        likeness(F.col("tree"), next_tree).alias("near_next"),
        edited_paragraphs(F.col("tree"), F.col("edited_tree")).alias("edit"),
    )
