"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tidepool.llm import url_filter
from tidepool.llm.queries import URL_RULES


def _op1() -> str:
    def hits(terms: tuple[str, ...]) -> str:
        return " + ".join(f"CAST(regexp_matches(folded, '(^|[^a-z0-9]){t}($|[^a-z0-9])') AS INT)" for t in terms)

    rules = sorted(URL_RULES, key=lambda r: -len(r.host + r.path))
    fits = [(f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')", r)
            for r in rules]
    rule = " ".join(f"WHEN {c} THEN '{r.host}{r.path}'" for c, r in fits)
    action = " ".join(f"WHEN {c} THEN '{r.action}'" for c, r in fits)
    fold = f"'{url_filter.UPPER}', '{url_filter.LOWER}'"
    return f"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS whole, translate(coalesce(url, ''), {fold}) AS folded FROM pages
), split AS (
  SELECT page_id, folded,
         translate(regexp_extract(whole, '(?s)^.*?://([^/?#]*)', 1), {fold}) AS host,
         regexp_extract(whole, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), counted AS (
  SELECT page_id, host, path,
         CAST({hits(url_filter.STRICT_TERMS)} AS INT) AS strict_hits,
         CAST({hits(url_filter.SOFT_TERMS)} AS INT) AS soft_hits
  FROM split
)
SELECT page_id, host, path, CASE {rule} END AS rule,
       CASE {action} WHEN strict_hits * {url_filter.STRICT_WEIGHT} + soft_hits * {url_filter.SOFT_WEIGHT}
            >= {url_filter.REJECT_AT} THEN 'block' ELSE 'allow' END AS verdict,
       strict_hits, soft_hits
FROM counted"""


OP8 = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS whole,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), ranked AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER w AS keep_id,
         row_number() OVER w AS nth,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM texts
  WINDOW w AS (PARTITION BY text_sha256 ORDER BY length(whole) DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, nth = 1 AS kept, text_sha256 FROM ranked"""

OP13 = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size, row_number() OVER () AS nth
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS weight
  FROM sized GROUP BY source
), steps AS (
  SELECT *, 2 * source_size AS cap,
         coalesce(sum(2 * source_size) OVER w, 0) AS caps_before, coalesce(sum(weight) OVER w, 0) AS weights_before,
         row_number() OVER (ORDER BY 2 * source_size / weight, source) AS k,
         sum(weight) OVER () AS weights, sum(source_size) OVER () * 1.5::DOUBLE AS budget
  FROM sources
  WINDOW w AS (ORDER BY 2 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT arg_min((budget - caps_before) / (weights - weights_before), k) AS level FROM steps
  WHERE (budget - caps_before) / (weights - weights_before) * weight <= cap
), of_source AS (
  SELECT source, source_size, target,
         CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM (SELECT source, source_size, least(CAST(cap AS DOUBLE), coalesce(level * weight, cap)) AS target FROM steps, level)
), classes AS (
  SELECT s.source, CASE WHEN size > 0 THEN len(bin(size)) ELSE 0 END AS bits, sum(size) AS words,
         any_value(target - whole * source_size) AS extra
  FROM sized s JOIN of_source o ON s.source IS NOT DISTINCT FROM o.source GROUP BY ALL
), levels AS (
  SELECT *, (extra - coalesce(sum(words) OVER longer, 0)) / (sum(bits * words) OVER (PARTITION BY source)
            - coalesce(sum(bits * words) OVER longer, 0)) AS lvl
  FROM classes WHERE bits > 0 AND extra > 0
  WINDOW longer AS (PARTITION BY source ORDER BY bits DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), rates AS (
  SELECT source, bits,
         least(1.0::DOUBLE, coalesce(greatest(arg_max(lvl, bits) FILTER (lvl * bits <= 1) OVER (PARTITION BY source), 0.0) * bits, 1.0)) AS rate
  FROM levels
), ranked AS (
  SELECT s.*, source_size, target, whole, target - whole * source_size AS extra, rate,
         (CAST('0x' || substr(sha256('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM sized s JOIN of_source o ON s.source IS NOT DISTINCT FROM o.source
  LEFT JOIN rates r ON r.source IS NOT DISTINCT FROM s.source AND r.bits = CASE WHEN size > 0 THEN len(bin(size)) ELSE 0 END
), placed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY odds, doc_id, size, nth ROWS UNBOUNDED PRECEDING) AS running
  FROM (SELECT *, CASE WHEN rate >= 1 THEN 0 ELSE (u / (1 - u)) / (rate / (1 - rate)) END AS odds FROM ranked)
  WHERE rate > 0 AND size > 0
), gaps AS (
  SELECT *, extra - coalesce(max(running) FILTER (running <= extra) OVER (PARTITION BY source), 0) AS gap FROM placed
), last AS (
  SELECT source, arg_min(nth, struct_pack(off := abs(size - gap), running := running)) AS nth
  FROM gaps WHERE running > extra AND abs(size - gap) < gap GROUP BY source
), copies AS (
  SELECT r.doc_id, r.source, r.size, r.source_size, r.target,
         r.whole + coalesce(CAST(p.running <= p.extra AS INT), 0) + CAST(l.nth IS NOT NULL AS INT) AS copies
  FROM ranked r LEFT JOIN placed p ON p.nth = r.nth LEFT JOIN last l ON l.nth = r.nth
)
SELECT doc_id, source, size, source_size, target, CAST(copies AS BIGINT) AS copies, CAST(copies * size AS BIGINT) AS taken FROM copies"""

ORACLE_SQL: dict[str, str] = {"op1_url_filter": _op1(), "op8_exact_dedup": OP8, "op13_mixing": OP13}
