"""SQL of the registered queries that SQL can express, for DuckDB over the same tables."""

from .licenses import SEGMENT, SHINGLE, TEMPLATES
from .urls import RULES, SUFFIXES


def _texts(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _case(column: int) -> str:
    parts = []
    for rule in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        said = rule[1] + rule[2] if column == 0 else rule[0]
        parts.append(
            f"WHEN (host = '{rule[1]}' OR suffix(host, '.{rule[1]}')) AND starts_with(path, '{rule[2]}') THEN '{said}'"
        )
    return "CASE " + " ".join(parts) + " END"


def _level(name: str, above: str | None, parents: str) -> str:
    """Groups of a level with their prior means, its prior's strength, and the posteriors."""
    mean = "p.mean" if above else "(SELECT (sum(bad) + 1.0) / (sum(n) + 2) FROM known)"
    source = f"FROM g JOIN {parents} p ON g.{above} = p.name" if above else "FROM g"
    group = f"{above}, {name}" if above else name
    return f"""
{name}_groups AS (
  WITH g AS (SELECT {group}, sum(n) AS n, sum(bad) AS bad FROM known GROUP BY {group})
  SELECT g.{name} AS name, g.n, g.bad, {mean} AS mean {source}
), {name}_moments AS (
  SELECT sum(n * (bad / n - mean) * (bad / n - mean)) AS s, sum(n * mean * (1 - mean)) AS v, count(*) AS k, sum(n) AS n, sum(n * n) AS nn
  FROM {name}_groups WHERE n > 0
), {name}_strength AS (
  SELECT CASE WHEN k < 2 OR v IS NULL OR v = 0 OR n = k THEN 10.0
    ELSE 1 / least(greatest((s / (v / n) - (k - 1)) / (n - nn / n - (k - 1)), 0.001), 0.999) - 1 END AS m
  FROM {name}_moments
), {name}_post AS (
  SELECT name, m * mean + bad AS alpha, m * (1 - mean) + n - bad AS beta, (m * mean + bad) / (m + n) AS mean
  FROM {name}_groups, {name}_strength
)"""


URL_SQL = f"""
WITH parsed AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), hp AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parsed
), outcomes AS (
  SELECT host, (toxic = 1 OR quality = 0) AS bad FROM hp JOIN labels ON doc_id = page_id
), counts AS (
  SELECT host, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CAST(bad AS INTEGER)) AS DOUBLE) AS bad FROM outcomes WHERE bad IS NOT NULL GROUP BY host
), hosts AS (
  SELECT host, string_split(host, '.') AS labels, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS two
  FROM (SELECT DISTINCT host FROM hp)
), named AS (
  SELECT host, labels, CASE WHEN regexp_matches(host, '^[0-9]+(\\.[0-9]+){{3}}$') THEN ''
    WHEN two IN ({_texts(SUFFIXES)}) THEN two ELSE labels[-1] END AS suffix FROM hosts
), known AS (
  SELECT host, suffix, CASE WHEN suffix = '' THEN host
    ELSE array_to_string(list_slice(labels, -least(len(string_split(suffix, '.')) + 1, len(labels)), -1), '.') END AS domain,
    coalesce(n, 0) AS n, coalesce(bad, 0) AS bad
  FROM named LEFT JOIN counts USING (host)
), {_level("suffix", None, "")}, {_level("domain", "suffix", "suffix_post")}, {_level("host", "domain", "domain_post")}
SELECT page_id, host, path, {_case(0)} AS rule,
  coalesce({_case(1)}, CASE WHEN mean - 1.645 * sqrt(mean * (1 - mean) / (alpha + beta + 1)) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM hp JOIN host_post ON name = host
"""

_WORD = r"[^\x20\x09-\x0D]"
_BLANKS = r"[\x20\x09-\x0D]"

QUALITY_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines
  FROM documents
), win AS (
  SELECT doc_id, unnest(range(1, len(words) - 3)) AS p, words FROM d
), win2 AS (
  SELECT doc_id, p, array_to_string(words[p : p + 4], ' ') AS w FROM win
), twice AS (
  SELECT doc_id, p FROM win2 QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1
), rep AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 5)) AS q FROM twice) GROUP BY doc_id
), line AS (
  SELECT doc_id, source, text, trim(regexp_replace(lower(x), '{_BLANKS}+', ' ', 'g')) AS norm, len(regexp_extract_all(x, '{_WORD}+')) AS w
  FROM (SELECT doc_id, source, text, unnest(lines) AS x FROM d)
), hot AS (
  SELECT source, norm FROM line GROUP BY source, norm HAVING count(DISTINCT text) > 100
), gone AS (
  SELECT doc_id, sum(w) AS w FROM line JOIN hot ON line.norm = hot.norm AND line.source IS NOT DISTINCT FROM hot.source GROUP BY doc_id
), s AS (
  SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '{_BLANKS}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(words) - coalesce(gone.w, 0) AS BIGINT) AS n_left
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_left >= 10 AND 100 * n_left >= 50 * n_words AS kept
FROM s
"""

_NOT_WORD = r"[^\p{L}\p{N}]+"


def _shingles(words: str) -> str:
    return f"list_transform(range(1, len({words}) - {SHINGLE - 2}), lambda i: array_to_string({words}[i : i + {SHINGLE - 1}], ' '))"


_REACH = 2 * SEGMENT - SHINGLE

LICENSE_SQL = rf"""
WITH t AS (
  SELECT license, list_filter(string_split_regex(lower(body), '{_NOT_WORD}'), lambda x: x <> '') AS w
  FROM (VALUES {", ".join(f"({_texts(x)})" for x in TEMPLATES)}) v(license, body)
), ts AS (
  SELECT row_number() OVER () AS tid, license, list_distinct({_shingles("w")}) AS template, (SELECT max(len(w)) FROM t) AS longest FROM t
), d AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '{_NOT_WORD}'), lambda x: x <> '') AS w FROM documents
), ds AS (
  SELECT doc_id, {_shingles("w")} AS s FROM d
), placed AS (
  SELECT doc_id, unnest(s) AS g, unnest(range(1, len(s) + 1)) AS i FROM ds
), met AS (
  SELECT doc_id, tid, i, g FROM placed JOIN (SELECT tid, unnest(template) AS g FROM ts) x USING (g)
), win AS (
  SELECT DISTINCT doc_id, tid, unnest(range((greatest(i - {_REACH + 1}, 0) + {SEGMENT - 1}) // {SEGMENT} * {SEGMENT}, i, {SEGMENT})) AS pos FROM met
), span AS (
  SELECT doc_id, tid, license, pos, len(template) AS size, greatest(pos + 1 - longest, 1) AS low, longest FROM win JOIN ts USING (tid)
), hit AS (
  SELECT span.doc_id, license, count(DISTINCT g) / any_value(size) AS c
  FROM span JOIN met ON met.doc_id = span.doc_id AND met.tid = span.tid AND i BETWEEN low AND low + {_REACH} + 2 * longest
  GROUP BY span.doc_id, span.tid, license, pos
), best AS (
  SELECT doc_id, license, max(c) AS c FROM hit WHERE c >= 0.8 GROUP BY doc_id, license
), found AS (
  SELECT doc_id, count(*) AS n, string_agg(license, ',' ORDER BY license) AS l, string_agg(CAST(round(c, 4) AS VARCHAR), ',' ORDER BY license) AS c
  FROM best GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_licenses, coalesce(l, '') AS licenses, coalesce(c, '') AS containments
FROM documents LEFT JOIN found USING (doc_id)
"""

JACCARD_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}+') AS w
  FROM documents
), x AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM d
), n AS (
  SELECT doc_id, count(*) AS n FROM x GROUP BY doc_id
), pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM x a JOIN x b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM pair JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(b) FROM reach WHERE a = d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id)
"""
