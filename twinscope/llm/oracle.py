"""SQL for the queries of this package, from their definitions."""

from __future__ import annotations

from twinscope.llm.fingerprint import LEAF_CHARS, SECTION_ENDS
from twinscope.llm.reputation import LEAST_PRIOR, MOST_PRIOR, TWO_LABEL_SUFFIXES

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP4 = f"""
WITH d AS (SELECT doc_id, {_ALNUM.format("coalesce(text, '')")} AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_ALNUM.format("coalesce(text, '')")} AS w FROM benchmark),
p AS (
  SELECT DISTINCT item, least(len(w), 10) AS m, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)
),
o AS (
  SELECT DISTINCT doc_id, k, p.m, p.item
  FROM (
    SELECT doc_id, k, m, array_to_string(w[k : k + m - 1], ' ') AS win
    FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, (SELECT DISTINCT m FROM p))
  ) JOIN p USING (m, win)
),
h AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(k, k + m)) AS x FROM o) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT doc_id, item FROM o) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n, 0) AS n_items,
  sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN s USING (doc_id)
"""

_SPECIALS = r"length({0}) - length(regexp_replace({0}, '[\\<\[]', '', 'g'))"

OP9 = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(3 + sum(length(text) + {_SPECIALS.format('text')} + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 4 WHEN 'system' THEN 15
    ELSE 20 + length(role) + {_SPECIALS.format('role')} END) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

_PRIOR = f"""
  SELECT m, least(greatest(coalesce(CASE WHEN rho > 0 THEN 1 / rho - 1 END, {MOST_PRIOR}), {LEAST_PRIOR}), {MOST_PRIOR}) AS k FROM (
    SELECT m, CASE WHEN f * m * (1 - m) = 0 THEN NULL ELSE (s - (g - 1) * m * (1 - m)) / (f * m * (1 - m)) END AS rho FROM (
      SELECT m, g, sum(n * power(bad / n - m, 2)) AS s, any_value(nn) - sum(n * n) / nullif(any_value(nn), 0) - (g - 1) AS f
      FROM (SELECT (sum(bad) OVER () + 0.5) / (sum(n) OVER () + 1) AS m, count(*) OVER () AS g, sum(n) OVER () AS nn, n, bad
            FROM (SELECT n::DOUBLE AS n, bad::DOUBLE AS bad FROM {{0}} WHERE n > 0))
      GROUP BY m, g))
"""

OP10 = f"""
WITH u AS (
  SELECT page_id, {_LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages
),
j AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
h AS (SELECT host, string_split(host, '.') AS l, count(bad) AS n, coalesce(sum(bad), 0) AS bad FROM u LEFT JOIN j ON j.doc_id = u.page_id GROUP BY host),
h2 AS (SELECT *, CASE WHEN len(l) >= 3 AND array_to_string(l[-2:], '.') IN ({', '.join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)}) THEN 2 ELSE 1 END AS c FROM h),
hh AS (SELECT host, n, bad, array_to_string(l[-c:], '.') AS suffix, array_to_string(l[-(c + 1):], '.') AS domain FROM h2),
dd AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hh GROUP BY 1, 2),
ss AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM dd GROUP BY 1),
s1 AS (SELECT suffix, (bad + k * m) / (n + k) AS r FROM ss, ({_PRIOR.format('ss')})),
d1 AS (SELECT dd.domain, (dd.bad + k * s1.r) / (dd.n + k) AS r FROM dd JOIN s1 USING (suffix), ({_PRIOR.format('dd')})),
h1 AS (SELECT host, (hh.bad + k * d1.r) / (hh.n + k) AS r, hh.n + k AS t FROM hh JOIN d1 USING (domain), ({_PRIOR.format('hh')})),
v AS (
  SELECT page_id, host, path, r - 1.28 * sqrt(r * (1 - r) / (t + 1)) AS bound,
    CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM u JOIN h1 USING (host)
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN bound > 0.25 THEN 'block' ELSE 'allow' END AS verdict
FROM v
"""



def _leaves(text: str) -> str:
    found = rf"regexp_extract_all({text}, '[^.!?\n]{{0,{LEAF_CHARS}}}[.!?\n]+ ?|[^.!?\n]{{1,{LEAF_CHARS}}}')"
    return f"list_transform({found}, lambda x: length(x) || '-' || md5(x)[1:12])"


def _root(text: str) -> str:
    paras = f"list_transform(string_split({text}, chr(10)), lambda p: sha256(array_to_string({_leaves('p')}, ' ')))"
    joined = f"array_to_string(list_transform({paras}, lambda d: d || CASE WHEN d[1] IN ({', '.join(repr(c) for c in SECTION_ENDS)}) THEN '|' ELSE ' ' END), '')"
    secs = f"list_transform(list_filter(string_split({joined}, '|'), lambda s: length(s) > 0), lambda s: sha256(s))"
    return f"sha256(array_to_string({secs}, ' '))"


def _likeness(a: str, b: str) -> str:
    weight = "coalesce(list_sum(list_transform({0}, lambda c: CAST(split_part(c, '-', 1) AS BIGINT))), 0)"
    total = f"({weight.format(f'list_distinct({a})')} + {weight.format(f'list_distinct({b})')})"
    return f"coalesce(2.0::DOUBLE * {weight.format(f'list_intersect({a}, {b})')} / nullif({total}, 0)::DOUBLE, 0.0::DOUBLE)"


OP2 = f"""
WITH n AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (SELECT doc_id, t, coalesce(lead(t) OVER w, first_value(t) OVER w) AS f
  FROM n WINDOW w AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (SELECT *, substring(t, 1, length(t) - length(t) // 4) || substring(f, 1, length(t) // 4) AS d FROM m),
l AS (SELECT *, {_leaves("t")} AS lt, {_leaves("d")} AS ld, {_leaves("f")} AS lf, {_root("t")} AS rt, {_root("d")} AS rd FROM e)
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, sha256(d) AS edited_sha256,
  rt || ':' || array_to_string(lt, ',') AS fingerprint, rd || ':' || array_to_string(ld, ',') AS edited_fingerprint,
  CASE WHEN t = d THEN 1.0::DOUBLE ELSE {_likeness("lt", "ld")} END AS near_edited,
  CASE WHEN t = f THEN 1.0::DOUBLE ELSE {_likeness("lt", "lf")} END AS near_next
FROM l
"""

OP6 = r"""
WITH l AS (
  SELECT doc_id, i - 1 AS line, string_split(trim(regexp_replace(lower(raw[i]), '\s+', ' ', 'g')), ' ') AS w, raw[i] AS r
  FROM (SELECT doc_id, raw, unnest(range(1, len(raw) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS raw FROM documents))
),
f AS (SELECT w, array_to_string(w, ' ') AS t, min((doc_id, line)) AS first FROM l WHERE w <> [''] GROUP BY w),
c AS (SELECT t, first, w, unnest(range(1, len(w) + 2)) AS i FROM f WHERE len(w) >= 10),
v AS (
  SELECT t, first, array_to_string(w[1 : i - 1], ' ') AS x, array_to_string(w[i + 1 :], ' ') AS y FROM c WHERE i <= len(w)
  UNION ALL
  SELECT t, first, array_to_string(w[1 : i - 1], ' ') AS x, array_to_string(w[i :], ' ') AS y FROM c
),
n AS (SELECT t, min(e) AS near FROM v JOIN (SELECT x, y, min(first) AS e FROM v GROUP BY x, y) USING (x, y) GROUP BY t),
d AS (
  SELECT l.*, coalesce(least(f.first, coalesce(n.near, f.first)) < (l.doc_id, l.line), false) AS gone
  FROM l LEFT JOIN f ON f.w = l.w LEFT JOIN n ON n.t = f.t
)
SELECT doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped, coalesce(string_agg(r, chr(10) ORDER BY line) FILTER (WHERE NOT gone), '') AS text
FROM d GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""

OP11 = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, w, len(w) AS n
  FROM (SELECT doc_id, {_ALNUM.format("coalesce(text, '')")} AS w FROM documents) WHERE len(w) > 0
),
c AS (SELECT count(*) AS nn, sum(n) AS ll FROM d),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
q AS (
  SELECT item_id, i, term, count(*) AS qtf
  FROM (SELECT item_id, row_number() OVER () AS i, unnest({_ALNUM.format("coalesce(text, '')")}) AS term FROM benchmark)
  GROUP BY item_id, i, term
),
f AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM t GROUP BY term), c
),
s AS (
  SELECT item_id, i, d.doc_id, r, CAST(sum(qtf * f.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll)))) AS BIGINT) AS score
  FROM q JOIN f USING (term) JOIN t USING (term) JOIN d USING (r), c
  GROUP BY item_id, i, d.doc_id, r
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM s WHERE score > 0)
WHERE rank <= 20
"""

SQL: dict[str, str] = {"op6_line_dedup": OP6, "op2_fingerprints": OP2, "op4_decontamination": OP4, "op9_chat_format": OP9, "op10_url_reputation": OP10, "op11_lexical_search": OP11}
