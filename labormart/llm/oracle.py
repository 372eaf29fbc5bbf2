"""DuckDB forms of the near-duplicate and repeat operators, for small tables: every window and every pair."""

from __future__ import annotations

#: Words ``[^\\x20\\x09-\\x0D]+`` of a text.
_WORDS = "list_filter(regexp_split_to_array({text}, '[ \\t\\n\\x0B\\x0C\\r]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def jaccard_groups(words: int, percent: int, kept: bool) -> str:
    """Per row its set's size and the least id that links reach: all pairs of sets with a common shingle are counted."""
    more = ", c.component_id IS NOT DISTINCT FROM s.doc_id AS kept" if kept else ""
    return f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS uid, doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents
), s AS (
  SELECT uid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(generate_series(1, len(w) - {words - 1}), lambda i: array_to_string(w[i:i + {words - 1}], ' '))) END AS g
  FROM d
), t AS (SELECT uid, len(g) AS n, unnest(g) AS x FROM s),
o AS (SELECT a.uid AS a, b.uid AS b, a.n AS na, b.n AS nb, count(*) AS o FROM t a JOIN t b ON a.x = b.x AND a.uid < b.uid GROUP BY ALL),
l AS (SELECT a, b FROM o WHERE 100 * o >= {percent} * (na + nb - o)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT uid AS a, uid AS b FROM s UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT r.a AS uid, min(s.doc_id) AS component_id FROM r JOIN s ON r.b = s.uid GROUP BY r.a)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, c.component_id{more}
FROM s JOIN c ON s.uid = c.uid"""


#: op8: windows of 20 words by the text of the window; ids are unique here.
SUBSTRING = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
v AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k
      FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20)),
f AS (SELECT k, min((doc_id, i)) AS first FROM v GROUP BY k HAVING count(*) > 1),
g AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS p FROM v JOIN f USING (k) WHERE (doc_id, i) <> first),
x AS (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS p FROM d WHERE len(w) > 0),
y AS (SELECT x.doc_id, count(*) AS n, count(g.p) AS gone, string_agg(CASE WHEN g.p IS NULL THEN w[x.p] END, ' ' ORDER BY x.p) AS kept
      FROM x LEFT JOIN g ON x.doc_id = g.doc_id AND x.p = g.p GROUP BY x.doc_id)
SELECT d.doc_id, COALESCE(y.n, 0) AS n_words, COALESCE(y.gone, 0) AS n_removed, sha256(COALESCE(y.kept, '')) AS kept_sha256
FROM d LEFT JOIN y ON d.doc_id = y.doc_id"""
