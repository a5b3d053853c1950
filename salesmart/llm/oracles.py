"""DuckDB SQL of the secret scan: spans by splitting at matches, entropies window by window."""

from __future__ import annotations

import math

from salesmart.llm import secrets


def _found(name: str, pattern: str, keep: str = "true") -> str:
    """Rows (doc_id, start, end, value) of the matches of ``pattern``; ``keep`` may use m and g2 (group 2, if any)."""
    two = "regexp_extract_all(t, $p$" + pattern + "$p$, 2)" if pattern == secrets.ASSIGN else "m"
    return f"""{name}_0 AS (SELECT rid, t, string_split_regex(t, $p${pattern}$p$) AS p, regexp_extract_all(t, $p${pattern}$p$) AS m FROM texts),
{name}_1 AS (SELECT rid, p, m, {two} AS g, unnest(range(1, len(m) + 1)) AS i FROM {name}_0 WHERE len(m) > 0),
{name} AS (
  SELECT rid, g[i] AS value, m[i] AS whole,
         CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s,
         CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))) AS BIGINT) AS e
  FROM {name}_1)"""


_W = secrets.WINDOW
_BOUND = {k: _W * (math.log2(_W) - t) + 1e-9 for k, t in secrets.THRESHOLDS.items()}
_ALLOWED = " OR ".join(f"regexp_matches(value, $p${p}$p$)" for p in secrets.ALLOWED)

SECRETS_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
{_found("assign_", secrets.ASSIGN)},
{_found("access_", secrets.ACCESS)},
{_found("hex_", secrets.HEX)},
{_found("run_", secrets.CANDIDATE)},
tried AS (SELECT rid, s, whole AS value FROM run_ WHERE NOT ({_ALLOWED.replace("value", "whole")})),
windows AS (SELECT rid, s, value, unnest(range(0, length(value) - {_W} + 1)) AS o FROM tried),
letters AS (SELECT rid, s, value, o, unnest(string_split(substr(value, o + 1, {_W}), '')) AS c FROM windows),
counts AS (SELECT rid, s, value, o, c, count(*) AS n FROM letters GROUP BY ALL),
sums AS (SELECT rid, s, value, o, sum(n * log2(n)) AS x FROM counts GROUP BY ALL),
hot AS (SELECT rid, s, min(o) AS a, max(o) AS b FROM sums
        WHERE x <= CASE WHEN regexp_matches(value, '^[0-9a-fA-F]+$') THEN {_BOUND["hex"]!r} ELSE {_BOUND["base64"]!r} END GROUP BY rid, s),
spans AS (
  SELECT rid, 0 AS k, 'assign' AS kind, s, e FROM assign_ WHERE length(value) >= 6
  UNION ALL SELECT rid, 1, 'access', s, e FROM access_
  UNION ALL SELECT rid, 2, 'hex', s, e FROM hex_
  UNION ALL SELECT rid, 3, 'entropy', s + a, s + b + {_W} FROM hot),
per AS (
  SELECT rid, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) FILTER (k < 3) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) AS spans
  FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN per USING (rid)
"""
