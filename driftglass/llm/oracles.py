"""DuckDB SQL of the operators that SQL can express."""

from driftglass.llm import quality as Q

GAP, INK = Q.GAP, Q.INK


def _chars(text: str, pattern: str) -> str:
    return f"length({text}) - length(regexp_replace({text}, '{pattern}', '', 'g'))"


def _words(text: str, cut: str = GAP) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{cut}'), lambda w: w <> '')"


OP2 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, r, t, {_words('t')} AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{INK}')) AS ls FROM d),
tri AS (SELECT r, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM tri) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS i FROM again) GROUP BY r),
line AS (SELECT r, x, len({_words('x')}) AS n, lower(x) AS low, {_chars('x', Q.SYMBOLS)} AS sy, {_chars('x', Q.SEPARATORS)} AS se FROM (SELECT DISTINCT r, unnest(ls) AS x FROM w)),
good AS (
  SELECT r, sum(length(regexp_replace(x, '{GAP}', '', 'g'))) AS chars FROM line
  WHERE NOT ((n >= 12 AND NOT regexp_matches(x, '{Q.MARKS}')) OR sy > 0.25 * n OR (se >= 3 AND n <= 4 * se) OR regexp_matches(low, '{Q.MENU_LINE}') OR regexp_matches(low, '{Q.PHRASE}'))
  GROUP BY r),
base AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST({_chars('t', Q.SYMBOLS)} AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, coalesce(good.chars, 0) AS chars
  FROM w LEFT JOIN rep USING (r) LEFT JOIN good USING (r)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * chars >= 50 * word_chars AS kept FROM judged
"""

CUT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_words(_LOW, CUT)} AS ws FROM documents),
b AS (SELECT item_id, {_words(_LOW, CUT)} AS ws FROM benchmark),
iw AS (SELECT DISTINCT item_id, m, array_to_string(ws[i:i + m - 1], ' ') AS x FROM
  (SELECT item_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM (SELECT *, least(len(ws), 10) AS m FROM b WHERE len(ws) > 0))),
dw AS (SELECT r, i, m, array_to_string(ws[i:i + m - 1], ' ') AS x FROM
  (SELECT r, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM iw) WHERE len(ws) >= m)),
met AS (SELECT r, i, dw.m, item_id FROM dw JOIN iw ON dw.x = iw.x AND dw.m = iw.m),
hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + m)) AS p FROM met) GROUP BY r),
its AS (SELECT r, count(*) AS n, string_agg(s, ',' ORDER BY s) AS names FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM met) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(its.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""

_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {_words(_AZ)} AS ws FROM documents),
sh AS (SELECT DISTINCT r, array_to_string(ws[i:i + 3], ' ') AS s FROM (SELECT r, ws, unnest(range(1, greatest(1, len(ws) - 3) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
pairs AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.r < b.r GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN n nx ON nx.r = x JOIN n ny ON ny.r = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(r, o) AS (SELECT r, r FROM d UNION SELECT reach.r, e.y FROM reach JOIN edges e ON e.x = reach.o),
least AS (SELECT reach.r, min(o.doc_id) AS component_id FROM reach JOIN d o ON o.r = reach.o GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least.component_id FROM d LEFT JOIN n USING (r) JOIN least USING (r)
"""
