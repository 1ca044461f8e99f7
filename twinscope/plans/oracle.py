"""The same results in SQL, for the check against another engine.

Each statement is built from shared common table expressions. They follow the
definitions, not the Spark plans: lemmas are found by applying the suffix rules to
words, vectors by ranking unnested words, edit ratios by dynamic programming.
"""

from __future__ import annotations

from functools import reduce

from twinscope.functions.bags import DISTANCES
from twinscope.functions.fuzzy import SCORES
from twinscope.functions.text import PUNCTUATION, REPLACEMENTS, SEQUENCE_FILTERS, WHITESPACE
from twinscope.operators.lemma import SUFFIX_RULES
from twinscope.plans.catalog import REPLACEMENT_PROBE, SEED, STOP_WORDS

SQL: dict[str, str] = {}


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def replaced(c: str) -> str:
    return reduce(lambda acc, r: f"replace({acc}, {lit(r[0])}, {lit(r[1])})", REPLACEMENTS, c)


def unpunctuated(c: str) -> str:
    return f"regexp_replace({c}, {lit(PUNCTUATION)}, '', 'g')"


def normalised(c: str) -> str:
    inner = unpunctuated(replaced(f"coalesce(lower({c}), '')"))
    return f"trim(regexp_replace({inner}, {lit(WHITESPACE)}, ' ', 'g'))"


def r6(c: str) -> str:
    x = f"({c})::DOUBLE"
    return f"CASE WHEN isnan({x}) THEN -1.0::DOUBLE WHEN abs({x}) >= 1e9 THEN {x} ELSE floor({x} * 1e6::DOUBLE + 0.5::DOUBLE) / 1e6::DOUBLE END"


def sequence(c: str) -> str:
    spaced = f"translate(lower({c}), {lit(SEQUENCE_FILTERS)}, {lit(' ' * len(SEQUENCE_FILTERS))})"
    return f"list_filter(string_split({spaced}, ' '), lambda w: w <> '')"


def words(c: str) -> str:
    """Words of a text whose spaces are collapsed."""
    return f"list_filter(string_split({c}, ' '), lambda w: w <> '')"


# --- lemmas ------------------------------------------------------------------------

LEXICON = f"""
lexicon AS MATERIALIZED (SELECT w AS word FROM (SELECT unnest({words('t')}) AS w FROM (SELECT {normalised('text')} AS t FROM documents))
  GROUP BY w HAVING count(*) >= 2)"""

_RULES = ", ".join(
    f"CASE WHEN ends_with(w, {lit(s)}) THEN left(w, length(w) - {len(s)}) || {lit(b)} END" for s, b in SUFFIX_RULES
)


def lemmas(texts: str) -> str:
    """``lemma(w, lemma)`` for the distinct words of a column ``t`` of a relation."""
    return f"""
vocab AS (SELECT DISTINCT unnest({words('t')}) AS w FROM {texts}),
forms AS (SELECT w, unnest([w, {_RULES}]) AS f FROM vocab),
lemma AS MATERIALIZED (SELECT w, arg_min(f, (length(f), f)) AS lemma FROM forms JOIN lexicon ON f = word GROUP BY w)"""


def lemmatised(relation: str, key: str, column: str, alias: str) -> str:
    return f"""
{alias} AS MATERIALIZED (SELECT r.{key}, coalesce(x.t, '') AS t FROM {relation} r LEFT JOIN (
    SELECT {key}, string_agg(coalesce(lemma, p.w), ' ' ORDER BY pos) AS t
    FROM (SELECT {key}, unnest({words(column)}) AS w, generate_subscripts({words(column)}, 1) AS pos FROM {relation}) p
    LEFT JOIN lemma USING (w) GROUP BY {key}) x USING ({key}))"""


# --- pair tables -------------------------------------------------------------------

DOC = """
d AS MATERIALIZED (SELECT doc_id, text, lower(split_part(text, chr(10), 1)) AS opening,
    lower(split_part(text, chr(10), -1)) AS ending FROM documents),
links AS (
  SELECT a.doc_id * 4 AS id, a.doc_id AS qid1, b.doc_id AS qid2 FROM d a JOIN d b ON b.doc_id = a.doc_id + 1
  UNION ALL SELECT doc_id * 4 + 1, doc_id, f FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY opening) AS f FROM d) WHERE f < doc_id
  UNION ALL SELECT doc_id * 4 + 2, f, doc_id FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY ending) AS f FROM d) WHERE f < doc_id
  UNION ALL SELECT doc_id * 4 + 3, doc_id, f FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS f FROM d) WHERE f < doc_id),
pairs AS (SELECT id, qid1, qid2, x.text AS question1, y.text AS question2, (x.ending = y.ending)::INT AS is_duplicate
  FROM links JOIN d x ON x.doc_id = qid1 JOIN d y ON y.doc_id = qid2)"""

DOC_CLEAN = (
    DOC
    + f""",
nd AS MATERIALIZED (SELECT doc_id, {normalised('text')} AS t FROM documents WHERE text IS NOT NULL),"""
    + LEXICON + "," + lemmas("nd") + "," + lemmatised("nd", "doc_id", "t", "ld")
    + """,
cleaned AS MATERIALIZED (SELECT id, is_duplicate, x.t AS q1, y.t AS q2
  FROM pairs JOIN ld x ON x.doc_id = qid1 JOIN ld y ON y.doc_id = qid2)"""
)

#: Every message with its number.
NUMBERED = """
msg AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY conv_id NULLS FIRST, turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n FROM conversations)"""

#: Every message, cleaned and lemmatised.
MESSAGES = (
    f"""
nm AS MATERIALIZED (SELECT n AS m, {normalised('text')} AS t FROM msg WHERE text IS NOT NULL),"""
    + LEXICON + "," + lemmas("nm") + "," + lemmatised("nm", "m", "t", "lm")
)

TURN = NUMBERED + """,
pairs AS (SELECT a.n * 2 + (b.turn - a.turn) - 1 AS id, a.n AS qid1, b.n AS qid2,
    a.text AS question1, b.text AS question2, (a.role = b.role)::INT AS is_duplicate
  FROM msg a JOIN msg b ON a.conv_id = b.conv_id AND b.turn IN (a.turn + 1, a.turn + 2))"""

TURN_CLEAN = TURN + "," + MESSAGES + """,
cleaned AS MATERIALIZED (SELECT id, is_duplicate, x.t AS q1, y.t AS q2 FROM pairs JOIN lm x ON x.m = qid1 JOIN lm y ON y.m = qid2)"""

OPEN = NUMBERED + """,
pairs AS (SELECT coalesce(4 * l.n, 4 * r.n - 1) AS id, coalesce(4 * l.n, 4 * r.n - 1) AS qid1, coalesce(4 * r.n, 4 * l.n + 1) AS qid2,
    l.text AS question1, r.text AS question2, coalesce((l.role = r.role)::INT, 0) AS is_duplicate
  FROM msg l FULL JOIN msg r ON r.conv_id = l.conv_id AND r.turn = l.turn + 1)"""

OPEN_CLEAN = OPEN + "," + MESSAGES + """,
cleaned AS MATERIALIZED (SELECT id, is_duplicate, x.t AS q1, y.t AS q2 FROM pairs JOIN lm x ON 4 * x.m = qid1 JOIN lm y ON 4 * y.m = qid2)"""

OPEN_FILLED = OPEN + "," + MESSAGES + """,
cleaned AS MATERIALIZED (SELECT id, is_duplicate, coalesce(x.t, '') AS q1, coalesce(y.t, '') AS q2
  FROM pairs LEFT JOIN lm x ON 4 * x.m = qid1 LEFT JOIN lm y ON 4 * y.m = qid2)"""

def sql(name: str, ctes: str, body: str, recursive: bool = False) -> None:
    SQL[name] = f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}" if ctes else body


# --- sources, profiling ------------------------------------------------------------

PLAIN = "id, qid1, qid2, is_duplicate"
sql("scan_pairs_csv", OPEN, "SELECT id, qid1, qid2, question1, question2, is_duplicate FROM pairs")
VEC = "list_transform(embedding, lambda x: x::DOUBLE)"
sql(
    "scan_word_vectors", "",
    f"SELECT 'w' || vec_id AS word, len(embedding)::BIGINT AS dim, {r6('embedding[1]')} AS first_value, {r6(f'list_sum({VEC})')} AS total FROM embeddings",
)
sql("word_vector_count", "", "SELECT count(*) AS n_vectors FROM embeddings")
sql("profile_row_count", DOC, "SELECT count(*) AS n_rows FROM pairs")
sql("profile_head", DOC, "SELECT id, qid1, qid2, question1, question2, is_duplicate FROM pairs ORDER BY id LIMIT 5")
sql(
    "profile_info", OPEN,
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null FROM pairs"
        for c, t in (("id", "bigint"), ("qid1", "bigint"), ("qid2", "bigint"), ("question1", "string"), ("question2", "string"), ("is_duplicate", "int"))
    ),
)
ALL = "id, qid1, qid2, question1, question2, is_duplicate"
sql("null_question_rows", OPEN, f"SELECT {ALL} FROM pairs WHERE question1 IS NULL OR question2 IS NULL")
sql("qid_lookup", OPEN, f"SELECT {ALL} FROM pairs WHERE qid1 = 4 OR qid2 = 4")
KEPT = "pairs WHERE question1 IS NOT NULL AND question2 IS NOT NULL"
sql("drop_null_pairs", OPEN, f"SELECT {PLAIN} FROM {KEPT}")
sql("null_check_after_drop", OPEN, f"SELECT count(*) AS n_rows FROM (SELECT * FROM {KEPT}) WHERE question1 IS NULL OR question2 IS NULL")
sql("identical_pairs", DOC, f"SELECT {PLAIN} FROM pairs WHERE question1 = question2")
sql("repeated_pairs", DOC, "SELECT qid1, qid2, count(*) AS n FROM pairs GROUP BY qid1, qid2 HAVING count(*) > 1")
sql(
    "mirrored_pairs", DOC,
    """SELECT id, side, k AS pair_key, n_sides > 1 AS mirrored FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY side, id) AS rn,
    max(side) OVER (PARTITION BY k) - min(side) OVER (PARTITION BY k) + 1 AS n_sides
  FROM (SELECT id, 0 AS side, qid1 || '-' || qid2 AS k FROM pairs UNION ALL SELECT id, 1, qid2 || '-' || qid1 FROM pairs))
WHERE rn > 1""",
)
sql("distinct_qids", DOC, "SELECT 'qid1' AS column_name, count(DISTINCT qid1) AS n_distinct FROM pairs UNION ALL SELECT 'qid2', count(DISTINCT qid2) FROM pairs")
sql("label_counts", DOC, "SELECT is_duplicate, count(id) AS n FROM pairs GROUP BY is_duplicate")
_SPLIT = lambda c: f"len(list_filter(string_split_regex({c}, {lit(WHITESPACE)}), lambda w: w <> ''))"
sql(
    "question_length_stats", DOC,
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {r6(f'avg({_SPLIT(c)})')} AS mean_words, {r6(f'median({_SPLIT(c)})')} AS median_words FROM pairs"
        for c in ("question1", "question2")
    ),
)
PCT = "round_even(avg(is_duplicate) * 100, 2)"
sql("class_balance", DOC, f"SELECT {r6(f'100.0 - {PCT}')} AS pct_not_duplicate, {r6(PCT)} AS pct_duplicate FROM pairs")
KEY = f"md5(id || ':{SEED}')"
HASH = f"('0x' || left({KEY}, 8))::BIGINT % 100"


def sample(zero: int, one: int) -> str:
    return f"""SELECT {PLAIN} FROM (SELECT *, row_number() OVER (PARTITION BY is_duplicate ORDER BY {KEY}, id) AS rn FROM pairs)
WHERE rn <= CASE is_duplicate WHEN 0 THEN {zero} ELSE {one} END"""


sql("balanced_sample", DOC, sample(100, 100))
sql("stratified_sample", DOC, sample(70, 140))
sql("hash_fraction_sample", DOC, f"SELECT {PLAIN} FROM pairs WHERE {HASH} < 1")
sql("label_preview", DOC, f"SELECT {ALL} FROM pairs WHERE is_duplicate = 1 ORDER BY id LIMIT 5")
sql("label_values", DOC, "SELECT DISTINCT is_duplicate FROM pairs")

# --- text --------------------------------------------------------------------------

sql("norm_lower", "", "SELECT doc_id, lower(text) AS text FROM documents")
sql("norm_replace", "", f"SELECT doc_id, {replaced('lower(text) || ' + lit(REPLACEMENT_PROBE))} AS text FROM documents")
sql("norm_punct", "", f"SELECT doc_id, {unpunctuated('text')} AS text FROM documents")
sql(
    "norm_lemma",
    f"nd AS MATERIALIZED (SELECT doc_id, {normalised('text')} AS t FROM documents)," + LEXICON + "," + lemmas("nd") + "," + lemmatised("nd", "doc_id", "t", "l"),
    "SELECT doc_id, t AS text FROM l",
)
sql("clean_pairs", TURN_CLEAN, "SELECT id, q1 AS question1, q2 AS question2 FROM cleaned")
STOP = "[" + ", ".join(lit(w) for w in STOP_WORDS) + "]"
sql(
    "norm_stopwords", "",
    f"SELECT doc_id, array_to_string(list_filter(string_split(t, ' '), lambda w: w <> '' AND NOT list_contains({STOP}, w)), ' ') AS text FROM (SELECT doc_id, {normalised('text')} AS t FROM documents)",
)
sql("word_sequence", "", f"SELECT doc_id, array_to_string({sequence('text')}, ' ') AS words, len({sequence('text')})::BIGINT AS n FROM documents")

# --- features ----------------------------------------------------------------------


def overlap(src: str = "cleaned") -> str:
    return f"""
overlap AS MATERIALIZED (SELECT id, is_duplicate, abs(len(a) - len(b))::BIGINT AS words_diff_q1_q2,
    len(list_intersect(a, b))::BIGINT AS word_common, (len(list_distinct(a)) + len(list_distinct(b)))::BIGINT AS word_total,
    len(list_intersect(a, b)) / (len(list_distinct(a)) + len(list_distinct(b)))::DOUBLE AS word_share
  FROM (SELECT id, is_duplicate, string_split(q1, ' ') AS a, string_split(q2, ' ') AS b FROM {src}))"""


def vectors(src: str = "cleaned") -> str:
    return f"""
tok AS (SELECT id, 1 AS side, unnest({words('q1')}) AS w FROM {src} UNION ALL SELECT id, 2, unnest({words('q2')}) FROM {src}),
num AS (SELECT id, side, dense_rank() OVER (PARTITION BY id ORDER BY w) AS r FROM tok),
nums AS (SELECT id, list(r ORDER BY r) FILTER (side = 1) AS a, list(r ORDER BY r) FILTER (side = 2) AS b FROM num GROUP BY id),
vec AS MATERIALIZED (SELECT id, is_duplicate,
    list_concat(list_resize([]::BIGINT[], len(b), 0::BIGINT), a) AS u, list_concat(list_resize([]::BIGINT[], len(a), 0::BIGINT), b) AS v
  FROM (SELECT id, is_duplicate, coalesce(a, []) AS a, coalesce(b, []) AS b FROM {src} LEFT JOIN nums USING (id)))"""


def _sum(expr: str) -> str:
    return f"coalesce(list_sum(list_transform(z, lambda x: ({expr})::DOUBLE)), 0)"


DIST = f"""
dist AS MATERIALIZED (SELECT id, is_duplicate,
    CASE WHEN uu = 0 OR vv = 0 THEN 'nan'::DOUBLE ELSE 1 - dot / (sqrt(uu) * sqrt(vv)) END AS cosine_distance, l1 AS cityblock_distance,
    CASE WHEN nz = 0 THEN 0 ELSE ne / nz END AS jaccard_distance, can AS canberra_distance, sqrt(sq) AS euclidean_distance,
    sqrt(sq) AS minkowski_distance, pow(cu, 1.0 / 3) AS minkowski_3, CASE WHEN tot = 0 THEN 'nan'::DOUBLE ELSE l1 / tot END AS braycurtis_distance
  FROM (SELECT id, is_duplicate, {_sum('x[1] * x[2]')} AS dot, {_sum('x[1] * x[1]')} AS uu, {_sum('x[2] * x[2]')} AS vv,
      {_sum('abs(x[1] - x[2])')} AS l1, {_sum('(x[1] - x[2]) * (x[1] - x[2])')} AS sq, {_sum('pow(abs(x[1] - x[2]), 3)')} AS cu,
      {_sum('x[1] + x[2]')} AS tot, {_sum('CASE WHEN x[1] + x[2] = 0 THEN 0 ELSE abs(x[1] - x[2]) / (x[1] + x[2])::DOUBLE END')} AS can,
      {_sum('(x[1] <> x[2])::INT')} AS ne, {_sum('(x[1] + x[2] > 0)::INT')} AS nz
    FROM (SELECT id, is_duplicate, list_zip(u, v) AS z FROM vec)))"""


def ngrams(n: int, name: str, src: str = "cleaned") -> str:
    def grams(c: str) -> str:
        ahead = "".join(f" || ' ' || lead(w, {k}) OVER (PARTITION BY id ORDER BY pos)" for k in range(1, n))
        return f"(SELECT id, w{ahead} AS g FROM (SELECT id, unnest({words(c)}) AS w, generate_subscripts({words(c)}, 1) AS pos FROM {src}))"

    return f"""
ng{n} AS MATERIALIZED (SELECT s.id, count(x.g)::BIGINT AS {name} FROM {src} s LEFT JOIN (
    SELECT a.id, a.g FROM {grams('q1')} a SEMI JOIN {grams('q2')} b ON a.id = b.id AND a.g = b.g) x ON x.id = s.id GROUP BY s.id)"""


def flesch(c: str) -> str:
    y = f"list_sum(list_transform({words(c)}, lambda w: greatest(1, len(regexp_extract_all(regexp_replace(w, 'e$', ''), '[aeiouy]+')))))"
    return f"CASE WHEN len({words(c)}) = 0 THEN 0.0 ELSE 206.835::DOUBLE - 1.015::DOUBLE * len({words(c)}) - 84.6::DOUBLE * ({y} / len({words(c)})::DOUBLE) END"


FEAT = DOC_CLEAN + "," + overlap()
VECS = DOC_CLEAN + "," + vectors()
DISTS = VECS + "," + DIST
sql("feat_words_diff", FEAT, "SELECT id, words_diff_q1_q2 FROM overlap")
sql("feat_word_common", FEAT, "SELECT id, word_common FROM overlap")
sql("feat_word_total", FEAT, "SELECT id, word_total FROM overlap")
sql("feat_word_share", FEAT, f"SELECT id, {r6('word_share')} AS word_share FROM overlap")
sql("feat_pair_vectors", VECS, "SELECT id, array_to_string(u, ' ') AS vec1, array_to_string(v, ' ') AS vec2 FROM vec")
for _n in ("cosine", "cityblock", "jaccard", "canberra", "euclidean", "braycurtis"):
    sql(f"feat_{_n}", DISTS, f"SELECT id, {r6(f'{_n}_distance')} AS {_n}_distance FROM dist")
sql("feat_minkowski", DISTS, f"SELECT id, {r6('minkowski_3')} AS minkowski_distance FROM dist")
OPEN_DIST = OPEN_FILLED + "," + vectors() + "," + DIST
sql(
    "drop_incomplete_features", OPEN_DIST,
    f"SELECT id, {r6('cosine_distance')} AS cosine_distance, {r6('cityblock_distance')} AS cityblock_distance FROM dist WHERE NOT isnan(cosine_distance)",
)
sql("feat_bigrams", DOC_CLEAN + "," + ngrams(2, "common_bigrams"), "SELECT id, common_bigrams FROM ng2")
sql("feat_trigrams", DOC_CLEAN + "," + ngrams(3, "common_trigrams"), "SELECT id, common_trigrams FROM ng3")
sql("feat_readability", DOC_CLEAN, f"SELECT id, {r6(flesch('q1'))} AS q1_readability_score, {r6(flesch('q2'))} AS q2_readability_score FROM cleaned")
_TW = lambda c: f"regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}_]{{2,}}')"
sql(
    "tfidf_cosine",
    DOC_CLEAN + f""",
tw AS (SELECT id, 1 AS side, unnest({_TW('q1')}) AS w FROM cleaned UNION ALL SELECT id, 2, unnest({_TW('q2')}) FROM cleaned),
tc AS (SELECT id, w, count(*) FILTER (side = 1) AS a, count(*) FILTER (side = 2) AS b FROM tw GROUP BY id, w),
tr AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY a + b DESC, w) AS rn FROM tc),
ti AS (SELECT id, a * idf AS x, b * idf AS y FROM (SELECT *, CASE WHEN a > 0 AND b > 0 THEN 1.0::DOUBLE ELSE 1.0 + ln(1.5::DOUBLE) END AS idf FROM tr)),
ts AS (SELECT id, sum(x * y) AS dot, sqrt(sum(x * x)) * sqrt(sum(y * y)) AS norm FROM ti GROUP BY id)""",
    f"SELECT id, {r6('CASE WHEN coalesce(norm, 0) > 0 THEN dot / norm ELSE 0 END')} AS tfidf_cosine FROM cleaned LEFT JOIN ts USING (id)",
)

sql(
    "corpus_tfidf_cosine",
    DOC_CLEAN + f""",
ctf AS MATERIALIZED (SELECT doc_id, w, count(*) AS tf FROM (SELECT doc_id, unnest({_TW('t')}) AS w FROM ld) GROUP BY doc_id, w),
cdf AS (SELECT w, count(*) AS df FROM ctf GROUP BY w),
cw0 AS MATERIALIZED (SELECT doc_id, w, tf * (ln((1.0::DOUBLE + (SELECT count(*) FROM ld)) / (1.0::DOUBLE + df)) + 1.0::DOUBLE) AS x FROM ctf JOIN cdf USING (w)),
cn AS (SELECT doc_id, sqrt(sum(x * x)) AS n FROM cw0 GROUP BY doc_id),
cu AS MATERIALIZED (SELECT doc_id, w, x / n AS x FROM cw0 JOIN cn USING (doc_id)),
cd AS (SELECT id, sum(a.x * b.x) AS dot FROM links JOIN cu a ON a.doc_id = qid1 JOIN cu b ON b.doc_id = qid2 AND b.w = a.w GROUP BY id)""",
    f"SELECT links.id, {r6('coalesce(dot, 0)')} AS cosine FROM links LEFT JOIN cd USING (id)",
)

# --- edit ratios -------------------------------------------------------------------


def _full(c: str) -> str:
    return f"trim(lower(regexp_replace(regexp_replace({c}, '[^\\x00-\\x7f]', '', 'g'), '[^A-Za-z0-9_]', ' ', 'g')))"


def _except(a: str, b: str) -> str:
    return f"list_sort(list_distinct(list_filter({a}, lambda w: NOT list_contains({b}, w))))"


def fuzzy(src: str = "cleaned") -> str:
    """``full1/2``, sorted ``s1/2``, set strings ``c1/2``, shared words ``sect``."""
    return f"""
fp AS (SELECT id, q1, q2, {_full('q1')} AS p1, {_full('q2')} AS p2 FROM {src}),
ft AS (SELECT *, list_sort(list_filter(string_split(p1, ' '), lambda w: w <> '')) AS t1, list_sort(list_filter(string_split(p2, ' '), lambda w: w <> '')) AS t2 FROM fp),
fs AS (SELECT *, array_to_string(list_sort(list_distinct(list_intersect(t1, t2))), ' ') AS sect FROM ft),
fz AS MATERIALIZED (SELECT id, q1, q2, p1, p2, array_to_string(t1, ' ') AS s1, array_to_string(t2, ' ') AS s2, sect,
    trim(sect || ' ' || array_to_string({_except('t1', 't2')}, ' ')) AS c1, trim(sect || ' ' || array_to_string({_except('t2', 't1')}, ' ')) AS c2,
    p1 <> '' AND p2 <> '' AS valid, greatest(length(p1), length(p2)) / greatest(1, least(length(p1), length(p2)))::DOUBLE AS span FROM fs)"""


def _codes(c: str) -> str:
    return f"list_transform(string_split({c}, ''), lambda x: unicode(x))"


def lcs(tasks: str, out: str) -> str:
    """Ratio of every ``(k, x, y)``: longest common subsequence along anti-diagonals."""
    return f"""
{out}_t AS MATERIALIZED (SELECT k, {_codes('a')} AS a, length(a) AS m, length(b) AS n,
    list_reverse(list_concat(list_resize([]::INT[], length(a), -1), {_codes('b')}, list_resize([]::INT[], length(a), -1))) AS br
  FROM (SELECT k, CASE WHEN length(x) <= length(y) THEN x ELSE y END AS a, CASE WHEN length(x) <= length(y) THEN y ELSE x END AS b FROM ({tasks}))
  WHERE a <> '' AND a <> b),
{out}_r AS (SELECT k, 0 AS d, list_resize([]::INT[], m, 0) AS p1, list_resize([]::INT[], m, 0) AS p2, a, br, m, n FROM {out}_t
  UNION ALL SELECT k, d + 1, list_transform(list_zip(p1, list_concat([0], p1[1:m-1]), list_concat([0], p2[1:m-1]), a, br[n+m-d+1:n+m-d+m]),
      lambda z: greatest(z[1], z[2], z[3] + (z[4] = z[5])::INT)), p1, a, br, m, n FROM {out}_r WHERE d < m + n),
{out} AS MATERIALIZED (SELECT t.k, CASE WHEN x = y THEN 100 WHEN x = '' OR y = '' THEN 0
    ELSE round_even(100 * (2 * common / (length(x) + length(y))::DOUBLE), 0) END AS score
  FROM ({tasks}) t LEFT JOIN (SELECT k, p1[m] AS common FROM {out}_r WHERE d = m + n) USING (k))"""


def window(tasks: str, out: str) -> str:
    """Best ratio of the shorter string over all windows of the longer, by combing."""
    swap = "x[3] = x[4] OR x[1] > x[2]"
    return f"""
{out}_t AS MATERIALIZED (SELECT k, list_reverse({_codes('a')}) AS a, length(a) AS m, length(b) AS n,
    list_concat(list_resize([]::INT[], length(a), -1), {_codes('b')}, list_resize([]::INT[], length(a), -1)) AS b
  FROM (SELECT k, CASE WHEN length(x) <= length(y) THEN x ELSE y END AS a, CASE WHEN length(x) <= length(y) THEN y ELSE x END AS b FROM ({tasks}))
  WHERE a <> '' AND NOT contains(b, a)),
{out}_r AS (SELECT k, 0 AS d, range(0, m)::INT[] AS h,
    list_concat(list_resize([]::INT[], m, 1000000000), range(m, m + n)::INT[], list_resize([]::INT[], m, 1000000000)) AS v, a, b, m, n FROM {out}_t
  UNION ALL SELECT k, d + 1, list_transform(z, lambda x: CASE WHEN {swap} THEN x[2] ELSE x[1] END),
    list_concat(v[1:d+1], list_transform(z, lambda x: CASE WHEN {swap} THEN x[1] ELSE x[2] END), v[d+2+m:]), a, b, m, n
  FROM (SELECT *, list_zip(h, v[d+2:d+1+m], a, b[d+2:d+1+m]) AS z FROM {out}_r WHERE d < m + n - 1)),
{out}_f AS (SELECT k, m, n, list_transform(v[m+1:m+n], lambda x: x - m) AS s FROM {out}_r WHERE d = m + n - 1),
{out}_e AS (SELECT k, m, n, unnest(s) AS st, unnest(range(0, n)) AS en FROM {out}_f),
{out}_c AS (SELECT k, m, n, greatest(en - m + 1, 0) AS lo, least(st, n - m) AS hi FROM {out}_e WHERE st >= 0),
{out}_d AS (SELECT k, m, n, lo AS l, 1 AS x FROM {out}_c WHERE lo <= hi UNION ALL SELECT k, m, n, hi + 1, -1 FROM {out}_c WHERE lo <= hi
  UNION ALL SELECT k, m, n, unnest(range(0, n - m + 1)), 0 FROM {out}_f),
{out}_s AS (SELECT k, m, n, l, sum(sum(x)) OVER (PARTITION BY k ORDER BY l) AS c FROM {out}_d GROUP BY k, m, n, l),
{out} AS MATERIALIZED (SELECT t.k, CASE WHEN x = y THEN 100 WHEN x = '' OR y = '' THEN 0 WHEN contains(x, y) OR contains(y, x) THEN 100
    ELSE round_even(100 * (2 * common / (2 * least(length(x), length(y)))::DOUBLE), 0) END AS score
  FROM ({tasks}) t LEFT JOIN (SELECT k, any_value(m) - min(c) AS common FROM {out}_s WHERE l <= n - m GROUP BY k) USING (k))"""


TASKS = {
    "r_full": ("lcs", "SELECT id AS k, p1 AS x, p2 AS y FROM fz"),
    "r_sort": ("lcs", "SELECT id AS k, s1 AS x, s2 AS y FROM fz"),
    "r_sets": ("lcs", "SELECT id AS k, c1 AS x, c2 AS y FROM fz"),
    "w_raw": ("window", "SELECT id AS k, q1 AS x, q2 AS y FROM fz"),
    "w_full": ("window", "SELECT id AS k, CASE WHEN span >= 1.5 THEN p1 ELSE '' END AS x, CASE WHEN span >= 1.5 THEN p2 ELSE '' END AS y FROM fz"),
    "w_sort": ("window", "SELECT id AS k, s1 AS x, s2 AS y FROM fz"),
    "w_sets": ("window", "SELECT id AS k, CASE WHEN sect = '' THEN c1 ELSE '' END AS x, CASE WHEN sect = '' THEN c2 ELSE '' END AS y FROM fz"),
}


def kernels(*names: str) -> str:
    return ",".join({"lcs": lcs, "window": window}[TASKS[n][0]](TASKS[n][1], n) for n in names)


def _prefix(c: str) -> str:
    return f"CASE WHEN sect = '' THEN 0 ELSE round_even(100 * (2 * length(sect) / (length(sect) + length({c}))::DOUBLE), 0) END"


TOKEN_SET = f"greatest({_prefix('c1')}, {_prefix('c2')}, r_sets.score)"
PARTIAL_SET = "CASE WHEN sect = '' THEN w_sets.score ELSE 100 END"
SCALE = "CASE WHEN span > 8 THEN 0.6::DOUBLE ELSE 0.9::DOUBLE END"
WRATIO = f"""round_even(CASE WHEN span < 1.5 THEN greatest(r_full.score::DOUBLE, r_sort.score * 0.95::DOUBLE, {TOKEN_SET} * 0.95::DOUBLE)
  ELSE greatest(r_full.score::DOUBLE, w_full.score * {SCALE}, w_sort.score * 0.95::DOUBLE * {SCALE}, {PARTIAL_SET} * 0.95::DOUBLE * {SCALE}) END, 0)"""
FUZZY = {
    "fuzz_qratio": ("CASE WHEN valid THEN r_full.score ELSE 0 END", ["r_full"]),
    "fuzz_WRatio": (f"CASE WHEN valid THEN {WRATIO} ELSE 0 END", ["r_full", "r_sort", "r_sets", "w_full", "w_sort", "w_sets"]),
    "fuzz_partial_ratio": ("w_raw.score", ["w_raw"]),
    "fuzz_partial_token_set_ratio": (f"CASE WHEN valid THEN {PARTIAL_SET} ELSE 0 END", ["w_sets"]),
    "fuzz_partial_token_sort_ratio": ("w_sort.score", ["w_sort"]),
    "fuzz_token_set_ratio": (f"CASE WHEN valid THEN {TOKEN_SET} ELSE 0 END", ["r_sets"]),
    "fuzz_token_sort_ratio": ("r_sort.score", ["r_sort"]),
}


def _joined(names: list[str]) -> str:
    return "fz " + " ".join(f"JOIN {n} ON {n}.k = fz.id" for n in names)


for _key, _name in {
    "feat_qratio": "fuzz_qratio",
    "feat_wratio": "fuzz_WRatio",
    "feat_partial_ratio": "fuzz_partial_ratio",
    "feat_partial_token_set": "fuzz_partial_token_set_ratio",
    "feat_partial_token_sort": "fuzz_partial_token_sort_ratio",
    "feat_token_set": "fuzz_token_set_ratio",
    "feat_token_sort": "fuzz_token_sort_ratio",
}.items():
    _expr, _needs = FUZZY[_name]
    sql(_key, OPEN_CLEAN + "," + fuzzy() + "," + kernels(*_needs), f"SELECT id, ({_expr})::BIGINT AS {_name} FROM {_joined(_needs)}", recursive=True)

_ALL_KERNELS = list(TASKS)
#: Each feature as an expression over ``ALL_FROM``.
EXPRESSIONS = {
    **{c: c for c in ("words_diff_q1_q2", "word_common", "word_total", "word_share", *DISTANCES)},
    **{c: f"({FUZZY[c][0]})::BIGINT" for c in SCORES},
    **{c: c for c in ("common_bigrams", "common_trigrams")},
    "q1_readability_score": flesch("fz.q1"),
    "q2_readability_score": flesch("fz.q2"),
}
REAL = ["word_share", *DISTANCES, "q1_readability_score", "q2_readability_score"]
ALL_PARTS = ",".join(
    ["", overlap(), vectors(), DIST, ngrams(2, "common_bigrams"), ngrams(3, "common_trigrams"), fuzzy(), kernels(*_ALL_KERNELS)]
)
ALL_FROM = f"{_joined(_ALL_KERNELS)} JOIN overlap o ON o.id = fz.id JOIN dist ON dist.id = fz.id JOIN ng2 ON ng2.id = fz.id JOIN ng3 ON ng3.id = fz.id"
ALL_SHOWN = "fz.id, o.is_duplicate, " + ", ".join(f"{r6(e) if c in REAL else e} AS {c}" for c, e in EXPRESSIONS.items())
sql("pair_features", OPEN_CLEAN + ALL_PARTS, f"SELECT {ALL_SHOWN} FROM {ALL_FROM}", recursive=True)
for _name in ("feature_store_roundtrip", "feature_matrix"):
    sql(_name, TURN_CLEAN + ALL_PARTS, f"SELECT {ALL_SHOWN} FROM {ALL_FROM}", recursive=True)

# --- questions, words, vectors -----------------------------------------------------

QUESTIONS = TURN + """,
questions AS MATERIALIZED (SELECT qid, arg_min(q, (id, side)) AS question
  FROM (SELECT id, 0 AS side, qid1 AS qid, question1 AS q FROM pairs UNION ALL SELECT id, 1, qid2, question2 FROM pairs) GROUP BY qid)"""
CORPUS = f"""{MESSAGES},
cleaned AS MATERIALIZED (SELECT id, qid1, qid2, x.t AS q1, y.t AS q2 FROM pairs JOIN lm x ON x.m = qid1 JOIN lm y ON y.m = qid2),
corpus AS MATERIALIZED (SELECT id, q1 || ' ' || q2 AS doc FROM cleaned)"""
VOCAB = f"""
cw AS (SELECT id, unnest({sequence('doc')}) AS word, generate_subscripts({sequence('doc')}, 1) AS pos FROM corpus),
voc AS MATERIALIZED (SELECT word, row_number() OVER (ORDER BY freq DESC, first) AS idx, freq
  FROM (SELECT word, count(*) AS freq, min((id, pos)) AS first FROM cw GROUP BY word))"""
STORE = f"""
store AS MATERIALIZED (SELECT word, idx, freq, {VEC} AS vector FROM voc JOIN embeddings ON vec_id + 1 = idx)"""
sql("unique_questions", QUESTIONS, "SELECT qid, question FROM questions")
QW = f"""
qw AS MATERIALIZED (SELECT qid, word, count(*) AS n FROM (SELECT qid, unnest({sequence('question')}) AS word FROM questions) SEMI JOIN store USING (word) GROUP BY qid, word)"""
WITH_STORE = TURN + "," + CORPUS + """,
questions AS MATERIALIZED (SELECT qid, arg_min(q, (id, side)) AS question
  FROM (SELECT id, 0 AS side, qid1 AS qid, q1 AS q FROM cleaned UNION ALL SELECT id, 1, qid2, q2 FROM cleaned) GROUP BY qid),""" + VOCAB + "," + STORE
sql("in_vocab_tokens", WITH_STORE + "," + QW, "SELECT qid, word, n FROM qw")
sql(
    "incremental_questions", QUESTIONS,
    "SELECT qid, question FROM questions WHERE qid NOT IN (SELECT qid1 FROM pairs WHERE is_duplicate = 1 UNION ALL SELECT qid2 FROM pairs WHERE is_duplicate = 1)",
)
sql("resumed_questions", QUESTIONS, f"SELECT qid, len({sequence('question')})::BIGINT AS n_words FROM questions")
sql(
    "embedding_lookup", TURN + "," + CORPUS + "," + VOCAB + "," + STORE,
    f"SELECT voc.idx, voc.word, 64::BIGINT AS dim, {r6('coalesce(vector[1], 0)')} AS first_value, {r6('coalesce(list_sum(vector), 0)')} AS total FROM voc LEFT JOIN store USING (word)",
)
NEAREST = WITH_STORE + "," + QW + """,
unit AS MATERIALIZED (SELECT word, unnest(vector) / sqrt(list_sum(list_transform(vector, lambda x: x * x))) AS x, generate_subscripts(vector, 1) AS i FROM store),
unitv AS MATERIALIZED (SELECT word, list(x ORDER BY i) AS v FROM unit GROUP BY word),
mean AS MATERIALIZED (SELECT qid, list(x ORDER BY i) AS q FROM (SELECT qid, i, sum(n * x) AS x FROM qw JOIN unit USING (word) GROUP BY qid, i) GROUP BY qid),
best AS MATERIALIZED (SELECT qid, max(list_cosine_similarity(q, v)) AS similarity FROM mean CROSS JOIN unitv
  ANTI JOIN qw ON qw.qid = mean.qid AND qw.word = unitv.word GROUP BY qid)"""
sql("nearest_word", NEAREST, f"SELECT qid, {r6('similarity')} AS similarity FROM best")
sql(
    "feat_word2vec_diff", NEAREST,
    f"SELECT id, {r6('coalesce(abs(a.similarity - b.similarity), 999)')} AS word_2_vec_diff FROM pairs LEFT JOIN best a ON a.qid = qid1 LEFT JOIN best b ON b.qid = qid2",
)
sql("combined_text", TURN + "," + CORPUS, "SELECT id, doc FROM corpus")
sql("vocabulary_index", TURN + "," + CORPUS + "," + VOCAB, "SELECT word, idx, freq FROM voc")
ENCODED = TURN + "," + CORPUS + "," + VOCAB + """,
enc AS MATERIALIZED (SELECT corpus.id, coalesce(s, []) AS s FROM corpus LEFT JOIN (SELECT id, list(idx ORDER BY pos) AS s FROM cw JOIN voc USING (word) GROUP BY id) x ON x.id = corpus.id)"""
sql("encode_docs", ENCODED, "SELECT id, array_to_string(s, ' ') AS seq FROM enc")
LONGEST = f"(SELECT max(len({words('doc')})) FROM corpus)"
sql("max_doc_length", TURN + "," + CORPUS, f"SELECT {LONGEST}::BIGINT AS max_length")
sql(
    "padded_docs", ENCODED,
    f"SELECT id, array_to_string(list_concat(s[greatest(len(s) - n + 1, 1):], list_resize([]::BIGINT[], greatest(n - len(s), 0), 0::BIGINT)), ' ') AS seq, n AS n FROM (SELECT *, {LONGEST}::BIGINT AS n FROM enc)",
)

# --- preparation, evaluation, models -----------------------------------------------

sql("train_test_split", DOC, f"SELECT id, CASE WHEN {HASH} < 75 THEN 'train' ELSE 'test' END AS split FROM pairs")
sql(
    "stratified_folds", DOC,
    f"SELECT id, is_duplicate, ((row_number() OVER (ORDER BY is_duplicate, {KEY}, id) - 1) % 5)::INT AS fold FROM pairs",
)
#: All features of the turn pairs, the training part, and its means and deviations without NaN.
_KNOWN = lambda c: f"CASE WHEN NOT isnan({c}) THEN {c} END"
STATS = TURN_CLEAN + ALL_PARTS + f""",
wide AS MATERIALIZED (SELECT fz.id, o.is_duplicate, {', '.join(f'({e})::DOUBLE AS {c}' for c, e in EXPRESSIONS.items())} FROM {ALL_FROM}),
split AS MATERIALIZED (SELECT *, {HASH} < 75 AS train FROM wide),
stats AS (SELECT {', '.join(f'avg({_KNOWN(c)}) AS m_{c}, CASE WHEN stddev_pop({_KNOWN(c)}) = 0 THEN 1 ELSE stddev_pop({_KNOWN(c)}) END AS s_{c}' for c in EXPRESSIONS)} FROM split WHERE train)"""
sql("standardize", STATS, "SELECT id, " + ", ".join(f"{r6(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in EXPRESSIONS) + " FROM split, stats", recursive=True)
_MAX = "1.7976931348623157e308"
_FIX = lambda c: f"CASE WHEN isnan({c}) THEN 0 WHEN {c} = 'inf'::DOUBLE THEN {_MAX}::DOUBLE WHEN {c} = '-inf'::DOUBLE THEN -{_MAX}::DOUBLE ELSE {c} END"
_ODD = "(CASE WHEN word_common = 0 THEN 'inf'::DOUBLE ELSE word_share END)"
sql(
    "nan_to_num", OPEN_DIST + "," + overlap() + f""",
odd AS (SELECT dist.id, cosine_distance, {_ODD} AS above, -{_ODD} AS below FROM dist JOIN overlap ON overlap.id = dist.id)""",
    "SELECT id, " + ", ".join(f"{r6(_FIX(c))} AS {c}" for c in ("cosine_distance", "above", "below")) + " FROM odd",
)
SCORED = FEAT + """,
scored AS MATERIALIZED (SELECT is_duplicate AS y, word_share AS s, (word_share >= 0.25)::INT AS z FROM overlap),
cells AS (SELECT count(*) FILTER (y = 1 AND z = 1) AS tp, count(*) FILTER (y = 0 AND z = 0) AS tn,
  count(*) FILTER (y = 0 AND z = 1) AS fp, count(*) FILTER (y = 1 AND z = 0) AS fn FROM scored)"""
sql("eval_accuracy", SCORED, f"SELECT {r6('avg((y = z)::INT)')} AS accuracy FROM scored")
_DIV = lambda a, b: f"(({a}) / nullif({b}, 0)::DOUBLE)"
sql(
    "eval_report", SCORED + f""",
cls AS (SELECT '0' AS class, coalesce({_DIV('tn', 'tn + fn')}, 0) AS p, coalesce({_DIV('tn', 'tn + fp')}, 0) AS r, coalesce({_DIV('2 * tn', '2 * tn + fn + fp')}, 0) AS f, tn + fp AS n FROM cells
  UNION ALL SELECT '1', coalesce({_DIV('tp', 'tp + fp')}, 0), coalesce({_DIV('tp', 'tp + fn')}, 0), coalesce({_DIV('2 * tp', '2 * tp + fn + fp')}, 0), tp + fn FROM cells)""",
    f"""SELECT class, {r6('p')} AS precision, {r6('r')} AS recall, {r6('f')} AS f1, n::BIGINT AS support FROM cls
UNION ALL SELECT 'macro avg', {r6('avg(p)')}, {r6('avg(r)')}, {r6('avg(f)')}, sum(n)::BIGINT FROM cls
UNION ALL SELECT 'weighted avg', {r6('sum(p * n) / sum(n)')}, {r6('sum(r * n) / sum(n)')}, {r6('sum(f * n) / sum(n)')}, sum(n)::BIGINT FROM cls""",
)
sql(
    "eval_confusion", SCORED,
    "SELECT a.x AS label, b.x AS predicted, (SELECT count(*) FROM scored WHERE y = a.x AND z = b.x) AS n FROM (VALUES (0), (1)) a(x), (VALUES (0), (1)) b(x)",
)
sql(
    "eval_rates", SCORED,
    f"SELECT {r6(_DIV('tp', 'tp + fn'))} AS sensitivity, {r6(_DIV('tn', 'tn + fp'))} AS specificity, {r6(_DIV('tp', 'tp + fp'))} AS precision, {r6(_DIV('fp', 'fp + tn'))} AS false_positive_rate FROM cells",
)
sql(
    "eval_roc", SCORED,
    f"""SELECT {r6('s')} AS threshold, {r6('sum(sum(y)) OVER (ORDER BY s DESC) / (SELECT sum(y) FROM scored)::DOUBLE')} AS tpr,
  {r6('sum(sum(1 - y)) OVER (ORDER BY s DESC) / (SELECT sum(1 - y) FROM scored)::DOUBLE')} AS fpr FROM scored GROUP BY s""",
)
sql(
    "eval_auc", SCORED,
    f"""SELECT {r6('(sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y))::DOUBLE')} AS auc
FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0::DOUBLE AS r FROM scored)""",
)


def _joint(y: int) -> str:
    terms = " + ".join(
        f"CASE WHEN {_PRESENT(c)} THEN ln(k{y}_{c} + 1) ELSE ln(n{y} - k{y}_{c} + 1) END - ln(n{y} + 2)" for c in EXPRESSIONS
    )
    return f"ln(n{y} + 1) - ln(n0 + n1 + 2) + {terms}"


_PRESENT = lambda c: f"(NOT isnan({c}) AND {c} > m_{c})"
NB = STATS + f""",
seen AS (SELECT split.*, {', '.join(f'm_{c}' for c in EXPRESSIONS)} FROM split, stats),
fit AS (SELECT {', '.join(f'(count(*) FILTER (is_duplicate = {y}))::DOUBLE AS n{y}, ' + ', '.join(f'(count(*) FILTER (is_duplicate = {y} AND {_PRESENT(c)}))::DOUBLE AS k{y}_{c}' for c in EXPRESSIONS) for y in (0, 1))} FROM seen WHERE train)"""
for _name in ("model_bernoulli_nb", "model_bayes_batches"):
    sql(_name, NB, f"SELECT id, {r6(_joint(0))} AS log_joint_0, {r6(_joint(1))} AS log_joint_1 FROM seen, fit WHERE NOT train", recursive=True)
sql(
    "score_stream", OPEN_DIST + "," + overlap(),
    f"SELECT o.id, words_diff_q1_q2, word_common, word_total, {r6('word_share')} AS word_share, {r6('cosine_distance')} AS cosine_distance, {r6('cityblock_distance')} AS cityblock_distance FROM overlap o JOIN dist USING (id)",
)
WHOLE = "question1 IS NOT NULL AND question2 IS NOT NULL"
sql("model_roundtrip_same", TURN, f"SELECT id, true AS same FROM pairs WHERE {WHOLE}")
for _fitted in ("model_logreg", "model_decision_tree", "model_mlp_2"):
    sql(f"{_fitted}_valid", TURN, f"SELECT id, true AS valid FROM pairs WHERE {WHOLE} AND NOT ({HASH} < 75)")
