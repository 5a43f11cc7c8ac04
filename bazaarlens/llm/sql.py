"""DuckDB SQL with the same rows, for the queries that SQL can express on whole tables."""

from __future__ import annotations

# The exponent has a closed form for a repetition limit; the operator bisects it.
_MIXING = r"""
WITH counted AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens
  FROM documents),
totals AS (SELECT source, sum(tokens)::BIGINT AS source_tokens FROM counted GROUP BY source),
shares AS (
  SELECT *, source_tokens / (SELECT sum(source_tokens) FROM totals)::DOUBLE AS p FROM totals),
exponent AS (
  SELECT round(greatest(0, 1 - ln(2.0) / nullif(ln(max(p) / min(p)), 0)), 9)::DOUBLE AS a
  FROM shares WHERE p > 0),
raised AS (
  SELECT source, source_tokens,
    CASE WHEN p > 0 THEN pow(p, coalesce(a, 0)) ELSE 0 END AS w
  FROM shares, exponent),
plan AS (
  SELECT *, round(w * (SELECT max(source_tokens / w) FROM raised WHERE w > 0))::BIGINT AS budget
  FROM raised),
blocks AS (SELECT greatest(1, ceil(sum(budget) / 1048576.0))::BIGINT AS n FROM plan),
drawn AS (
  SELECT doc_id, c.source, tokens, source_tokens, budget, e.epoch::INT AS epoch,
    md5(concat_ws('/', '7', e.epoch::VARCHAR, coalesce(doc_id::VARCHAR, '-'))) AS key
  FROM counted c JOIN plan p ON c.source IS NOT DISTINCT FROM p.source,
    LATERAL (SELECT unnest(generate_series(1, greatest(1,
      CASE WHEN source_tokens > 0 THEN ceil(budget / source_tokens)::BIGINT ELSE 1 END))) AS epoch) e),
placed AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY source ORDER BY epoch, key, tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM drawn)
SELECT doc_id, source, tokens, epoch,
  least(floor(coalesce(before::DOUBLE / nullif(budget, 0), 0) * n), n - 1)::BIGINT AS block,
  before, key
FROM placed, blocks
WHERE epoch * source_tokens <= budget OR before < budget
"""

# Pairs of equal lines, the later one first, make diagonals; a piece of a diagonal without a gap is a
# maximal run that has occurred before, and goes with 150 characters.
_LINES = r"""
WITH split AS (
  SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts)))::INT AS pos FROM split),
pairs AS (
  SELECT a.doc_id, a.pos, length(a.line) AS size, b.doc_id AS other, a.pos - b.pos AS shift,
    a.pos - row_number() OVER (PARTITION BY a.doc_id, b.doc_id, a.pos - b.pos ORDER BY a.pos) AS island
  FROM lines a JOIN lines b USING (line)
  WHERE (a.doc_id, a.pos) > (b.doc_id, b.pos)),
runs AS (
  SELECT doc_id, min(pos) AS start, max(pos) AS stop
  FROM pairs GROUP BY doc_id, other, shift, island HAVING sum(size) >= 150),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(start, stop + 1))::INT AS pos FROM (SELECT DISTINCT * FROM runs)),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text
  FROM lines ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id),
counts AS (SELECT doc_id, count(*)::INT AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::INT AS lines_deleted,
  length(coalesce(k.text, ''))::BIGINT AS chars_kept, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN counts USING (doc_id)
"""

_URLS = r"""
WITH parts AS (
  SELECT page_id, url,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id, url,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
canonical AS (
  SELECT *, CASE WHEN regexp_replace(host, '^www\.', '') <> '' THEN
    regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') END AS canon
  FROM split),
listed AS (
  SELECT DISTINCT canon FROM canonical
  WHERE canon IS NOT NULL AND regexp_matches(host, '(^|\.)(spam-farm|adult-x)\.')),
rules(rule_host, rule_path, rule_verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fitting AS (
  SELECT DISTINCT url, rule_host || rule_path AS rule, rule_verdict
  FROM canonical JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
    AND starts_with(path, rule_path)),
best AS (
  SELECT * FROM fitting
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY length(rule) DESC, rule) = 1)
SELECT page_id, host, path, rule,
  CASE WHEN rule_verdict IS NOT NULL THEN rule_verdict
    WHEN canon IN (SELECT canon FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM canonical LEFT JOIN best USING (url)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_temperature_mixing": _MIXING,
    "op7_line_dedup": _LINES,
    "op10_url_filter": _URLS,
}
