"""SQL twins of the registered queries that SQL can express."""

from __future__ import annotations

from zephyrine.llm.decontaminate import UPPER
from zephyrine.llm.url_filter import RULES

_LOWER = f"translate({{0}}, '{UPPER}', '{UPPER.lower()}')"


def _words(text: str) -> str:
    lowered = _LOWER.format(f"coalesce({text}, '')")
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


LINES = rf"""
WITH split AS (
  SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
line AS (
  SELECT doc_id, i - 1 AS line_no, lines[i] AS line, doc_id * 1000000 + i - 1 AS place
  FROM split, unnest(range(1, len(lines) + 1)) AS t(i) WHERE regexp_matches(lines[i], '[^\x20\x09-\x0D]')),
firsts AS (SELECT line, length(line) AS n, min(place) AS place FROM line GROUP BY line),
half AS (
  SELECT f.*, m, side, CASE side WHEN 'l' THEN left(line, m // 2) ELSE right(line, m // 2) END AS piece
  FROM firsts f, unnest([n - 1, n]) AS t(m), (VALUES ('l'), ('r')) AS s(side)
  WHERE n >= 20),
pair AS (
  SELECT DISTINCT a.line AS early, b.line AS late, a.place AS near, a.n AS an, b.n AS bn
  FROM half a JOIN half b USING (m, side, piece)
  WHERE a.place < b.place AND abs(a.n - b.n) <= 1),
near AS (
  SELECT late AS line, min(near) AS near
  FROM pair, unnest(range(0, greatest(an, bn))) AS t(i)
  WHERE left(early, i) = left(late, i)
    AND CASE WHEN an = bn THEN right(early, an - i - 1) = right(late, bn - i - 1)
             WHEN an < bn THEN right(early, an - i) = right(late, an - i)
             ELSE right(early, bn - i) = right(late, bn - i) END
  GROUP BY late),
told AS (
  SELECT l.doc_id, l.line_no, f.place < l.place AS exact, f.place AS first_place, near
  FROM line l JOIN firsts f USING (line) LEFT JOIN near USING (line))
SELECT doc_id, line_no, CASE WHEN exact THEN 'exact' ELSE 'near' END AS kind,
  CASE WHEN exact THEN first_place ELSE near END // 1000000 AS kept_doc_id,
  CASE WHEN exact THEN first_place ELSE near END % 1000000 AS kept_line_no
FROM told WHERE exact OR near IS NOT NULL
"""

DECONTAMINATE = rf"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words('text')} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, array_to_string(list_slice(w, i, i + 9), ' ') AS p, least(len(w), 10) AS n
  FROM item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
doc AS (SELECT doc_id, {_words('text')} AS w FROM documents),
place AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS p
  FROM doc, (SELECT DISTINCT n FROM win) AS s, unnest(range(1, len(w) - n + 2)) AS t(i)),
met AS (
  SELECT doc_id, i, n, p FROM place JOIN (SELECT DISTINCT p, n FROM win) AS v USING (p, n)),
hit AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM met, unnest(range(i, i + n)) AS t(j) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(DISTINCT item) AS n_items,
    sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS digest
  FROM met JOIN win USING (p, n) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(digest, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def _rule_case(result: str) -> str:
    cases = []
    for rule in sorted(RULES, key=lambda r: (-len(r.name), r.verdict != "allow", r.name)):
        value = rule.name if result == "name" else rule.verdict
        cases.append(
            f"WHEN (host = '{rule.host}' OR ends_with(host, '.{rule.host}'))"
            f" AND starts_with(path, '{rule.path}') THEN '{value}'"
        )
    return f"CASE {' '.join(cases)} END"


def _address(url: str) -> str:
    scheme, host, tail = (f"regexp_extract({url}, '(?s)^([^#]*?://)([^/?#]*)([^#]*)', {i})" for i in (1, 2, 3))
    whole = f"{_LOWER.format(f'({scheme} || {host})')} || CASE WHEN {tail} = '' THEN '/' ELSE {tail} END"
    return f"CASE WHEN {scheme} <> '' THEN {whole} END"


def _plain(address: str) -> str:
    rest = f"regexp_replace({address}, '^https?://', 'https://')"
    path = f"regexp_replace(regexp_extract({rest}, '^([^?]*)', 1), '/+$', '')"
    query = f"regexp_extract({rest}, '^[^?]*[?](.*)$', 1)"
    kept = (
        f"array_to_string(list_filter(string_split({query}, '&'), "
        "lambda x: x <> '' AND NOT starts_with(x, 'utm_')), '&')"
    )
    return f"{path} || CASE WHEN {kept} <> '' THEN '?' || {kept} ELSE '' END"


_TAG = r"regexp_extract_all(html, '(?is)<{tag}\b[^>]*>')"

ALIASES = rf"""
WITH RECURSIVE page AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, {_address('url')} AS address
  FROM pages),
tag AS (
  SELECT url, address, regexp_extract(
      list_filter({_TAG.format(tag='link')},
        lambda x: regexp_matches(x, '(?is)\brel\s*=\s*["'']?canonical\b')
          AND regexp_matches(x, '(?is)\bhref\s*='))[1],
      '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS link FROM page
  UNION ALL
  SELECT url, address, regexp_extract(
      list_filter({_TAG.format(tag='meta')},
        lambda x: regexp_matches(x, '(?is)\bhttp-equiv\s*=\s*["'']?refresh\b')
          AND regexp_matches(x, '(?is)url\s*='))[1],
      '(?is)\bcontent\s*=\s*["'']?[^"''>]*?url\s*=\s*([^"''\s>]+)', 1) FROM page),
link AS (SELECT url, address, replace(link, '&amp;', '&') AS link FROM tag WHERE link <> ''),
target AS (
  SELECT address AS a, CASE WHEN instr(link, '://') > 0 THEN link
    WHEN starts_with(link, '//') THEN regexp_extract(url, '^([^:/?#]*:)//', 1) || link
    WHEN starts_with(link, '/') THEN regexp_extract(url, '^([^:/?#]*://[^/?#]*)', 1) || link END AS t
  FROM link),
linked AS (SELECT a, {_address('t')} AS b FROM target),
known AS (
  SELECT address AS a FROM page UNION SELECT a FROM linked WHERE b IS NOT NULL
  UNION SELECT b FROM linked WHERE a IS NOT NULL),
edge AS (
  SELECT md5(a) AS a, md5(b) AS b FROM linked WHERE a IS NOT NULL AND b IS NOT NULL
  UNION SELECT md5(a), md5({_plain('a')}) FROM known WHERE a IS NOT NULL),
ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
reach AS (
  SELECT md5(address) AS start, md5(address) AS node FROM page WHERE address IS NOT NULL
  UNION
  SELECT reach.start, ways.b FROM reach JOIN ways ON reach.node = ways.a),
component AS (SELECT start, min(node) AS component FROM reach GROUP BY start),
cut AS (
  SELECT page_id, address,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM page),
parts AS (
  SELECT page_id, address, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (
  SELECT p.*, {_rule_case('name')} AS rule, {_rule_case('verdict')} AS own, component
  FROM parts p LEFT JOIN component ON start = md5(address)),
blocked AS (
  SELECT component FROM ruled WHERE component IS NOT NULL AND own IS NOT NULL
  GROUP BY component HAVING max(own) = 'block' AND min(own) = 'block')
SELECT page_id, host, path, rule,
  coalesce(own, CASE WHEN component IN (SELECT component FROM blocked) THEN 'block' ELSE 'allow' END)
    AS verdict, component
FROM ruled
"""


def _terms(text: str) -> str:
    lowered = _LOWER.format(f"coalesce({text}, '')")
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


RANKED = rf"""
WITH item AS (
  SELECT DISTINCT item_id, unnest({_terms('text')}) AS term FROM benchmark),
doc AS (SELECT doc_id, {_terms('text')} AS terms FROM documents),
sized AS (SELECT doc_id, terms, CAST(len(terms) AS HUGEINT) AS n FROM doc WHERE len(terms) > 0),
total AS (SELECT CAST(count(*) AS HUGEINT) AS documents, sum(n) AS length FROM sized),
one AS (SELECT doc_id, n, unnest(terms) AS term FROM sized),
tf AS (SELECT doc_id, n, term, CAST(count(*) AS HUGEINT) AS tf FROM one GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
score AS (
  SELECT item_id, doc_id, sum(
      CAST(floor(1000 * ln(CAST(2 * documents + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS HUGEINT)
      * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * documents) // length)))) AS score
  FROM item JOIN tf USING (term) JOIN df USING (term), total GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM score WHERE score > 0) WHERE rank <= 10
"""
