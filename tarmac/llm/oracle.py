"""DuckDB SQL of the operator queries that SQL can express.

The others (encodings, fingerprints, learned models, page parsing) are tested against brute force.
"""

from __future__ import annotations

from tarmac.llm import line_quality as lq
from tarmac.llm import url_rules as ur
from tarmac.llm.decontaminate import COVERAGE, WINDOW
from tarmac.llm.queries import URL_RULES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _url_sql() -> str:
    upper, lower = _text(ur._UPPER), _text(ur._LOWER)
    rules = sorted(URL_RULES, key=lambda r: (len(r[1]), r[1]), reverse=True)
    fits = [
        f"(host = {_text(name)} OR ends_with(host, {_text('.' + name)})) AND starts_with(path, {_text('/' + rest)})"
        for name, _, rest in (rule.partition("/") for _, rule in rules)
    ]
    rule = "CASE " + " ".join(f"WHEN {f} THEN {_text(r)}" for f, (_, r) in zip(fits, rules)) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN {_text(v)}" for f, (v, _) in zip(fits, rules)) + " END"
    return f"""
WITH urls AS (
  SELECT row_number() OVER () AS row, page_id,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT row, page_id, translate(regexp_extract(rest, {_text(ur.HOST)}, 1), {upper}, {lower}) AS host,
    regexp_extract(rest, {_text(ur.PATH)}, 1) AS path, translate(rest, {upper}, {lower}) AS low FROM urls),
tokens AS (
  SELECT DISTINCT row, page_id, token FROM (
    SELECT row, page_id, unnest(list_concat(list_concat(
      list_transform(regexp_extract_all(regexp_extract(low, {_text(ur.HOST)}, 1), '[a-z0-9_]+'), lambda t: 'h:' || t),
      list_transform(regexp_extract_all(regexp_extract(low, {_text(ur.PATH)}, 1), '[a-z0-9_]+'), lambda t: 'p:' || t)),
      list_transform(regexp_extract_all('&' || regexp_extract(low, {_text(ur.QUERY)}, 1), '&([a-z0-9_]+)', 1), lambda t: 'q:' || t))) AS token
    FROM parts) t),
marked AS (
  SELECT doc_id, max(quality = 0 OR toxic = 1) AS bad FROM labels
  WHERE doc_id IS NOT NULL AND (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY doc_id),
known AS (SELECT row, token, bad FROM tokens JOIN marked ON page_id = doc_id),
least AS (SELECT greatest({ur.LEAST_URLS}, ceil({ur.SUPPORT} * count(DISTINCT row) FILTER (bad))) AS n FROM known),
have AS (
  SELECT row, bad, token AS a, token AS b FROM known
  UNION ALL SELECT x.row, x.bad, x.token, y.token FROM known x JOIN known y ON x.row = y.row AND x.token < y.token),
rules AS (
  SELECT a, b FROM have GROUP BY a, b
  HAVING count(*) FILTER (bad) >= (SELECT n FROM least) AND count(*) FILTER (bad) >= {ur.CONFIDENCE}::DOUBLE * count(*)),
hits AS (
  SELECT x.row, count(*) AS n FROM rules JOIN tokens x ON x.token = a JOIN tokens y ON y.token = b AND y.row = x.row GROUP BY x.row)
SELECT page_id, host, path, {rule} AS rule, coalesce({verdict}, CASE WHEN n > 0 THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(n, 0) AS n_mined
FROM parts LEFT JOIN hits ON hits.row = parts.row"""


def _quality_sql() -> str:
    spaces = _text(lq.SPACES)
    words = f"list_filter(regexp_split_to_array(LINE, {spaces}), lambda w: w <> '')"
    fails = f"""(NOT regexp_matches(line, '\\p{{L}}')
      OR (marks >= {lq.MARKS} AND 2 * marks > n) OR (entries >= 3 AND n - (entries - 1) <= 4 * entries)
      OR (n <= 4 AND regexp_matches(lower(regexp_replace(line, {_text(f'^{lq.SPACES}|{lq.SPACES}$')}, '', 'g')), {_text(lq.MENU)}))
      OR (n <= {lq.BOILERPLATE_WORDS} AND regexp_matches(lower(line), {_text(lq.PHRASES)})))"""
    return f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
worded AS (SELECT row, doc_id, text, {words.replace('LINE', 'text')} AS w FROM texts),
places AS (SELECT row, unnest(generate_series(1, len(w) - 2)) AS i, w FROM worded WHERE len(w) > 2),
windows AS (SELECT row, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM places),
repeated AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, a, b, c) AS n FROM windows) x WHERE n > 1),
covered AS (SELECT row, count(DISTINCT i + k) AS n FROM repeated, (VALUES (0), (1), (2)) s(k) GROUP BY row),
split AS (SELECT row, unnest(string_split(text, chr(10))) AS line FROM texts),
lines AS (
  SELECT row, line, len({words.replace('LINE', 'line')}) AS n, length(line) - length(regexp_replace(line, {_text(lq.LINE_MARKS)}, '', 'g')) AS marks,
    len(regexp_split_to_array(line, {_text(lq.SEPARATORS)})) AS entries FROM split WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
judged AS (SELECT row, line, n, {fails} AS failed FROM lines),
by_row AS (
  SELECT row, count(*) AS n_lines, count(DISTINCT line) AS n_different, count(*) FILTER (failed) AS n_failed, coalesce(sum(n) FILTER (failed), 0) AS lost
  FROM judged GROUP BY row),
measured AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(regexp_replace(text, {_text(lq.SYMBOLS)}, '', 'g')) AS n_symbols,
    coalesce(n_lines - n_different, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, coalesce(lost, 0) AS lost,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_failed, 0) AS n_failed
  FROM worded LEFT JOIN covered c ON c.row = worded.row LEFT JOIN by_row l ON l.row = worded.row),
based AS (SELECT *, n_words < {lq.LEAST_WORDS} OR 100 * n_repeat_words > {round(100 * lq.MOST_REPEATED)} * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * lost <= {round(100 * lq.MOST_LOST)} * n_words AS kept,
  CAST(lost AS BIGINT) AS n_lost_words, n_lines, n_failed AS n_failed_lines
FROM based"""


def _benchmark_sql() -> str:
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH items AS (SELECT item_id, {words} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS size, array_to_string(w[i : i + least(len(w), {WINDOW}) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), {WINDOW}) + 1)) AS i FROM items WHERE len(w) > 0) x),
docs AS (SELECT row_number() OVER () AS row, doc_id, {words} AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
grams AS (
  SELECT row, i, size, array_to_string(w[i : i + size - 1], ' ') AS gram
  FROM (SELECT row, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM docs, sizes WHERE len(w) >= size) x),
hits AS (SELECT row, i, size, item_id FROM grams JOIN windows USING (size, gram)),
covered AS (
  SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest(generate_series(i, i + size - 1)) AS p FROM (SELECT DISTINCT row, i, size FROM hits) h) x GROUP BY row),
named AS (
  SELECT row, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) x GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(m.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(c.n, 0) > 0 AND {COVERAGE[1]} * coalesce(c.n, 0) >= {COVERAGE[0]} * len(w) AS contaminated
FROM docs LEFT JOIN covered c ON c.row = docs.row LEFT JOIN named m ON m.row = docs.row"""


def _search_sql() -> str:
    terms = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {terms} AS w FROM documents),
sums AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM docs),
found AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM docs) x GROUP BY row, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM found GROUP BY term) x, sums),
sized AS (SELECT row, doc_id, 10 + (90 * len(w) * n_docs) // n_terms AS m FROM docs, sums WHERE len(w) > 0),
items AS (SELECT row_number() OVER () AS item, item_id, {terms} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark) x),
asked AS (SELECT DISTINCT item, item_id, unnest(w) AS term FROM items),
scored AS (
  SELECT item, item_id, row, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN found USING (term) JOIN weights USING (term) JOIN sized USING (row) GROUP BY item, item_id, row, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10"""


ORACLE_SQL: dict[str, str] = {
    "op3_url_rules": _url_sql(),
    "op5_line_quality": _quality_sql(),
    "op8_decontamination": _benchmark_sql(),
    "op12_ranked_search": _search_sql(),
}
