"""DuckDB twins of the test views (CTE bodies), used by the oracle SQL of every query."""

from __future__ import annotations

V1 = """v1 AS (SELECT event_type AS topic, CAST(user_id % 6 AS INTEGER) AS "partition",
  event_id AS "offset", ts, CAST(user_id AS VARCHAR) AS key, value, props, user_id FROM events)"""

V2 = """v2 AS (SELECT CAST(o_custkey AS VARCHAR) AS key, o_orderkey AS "offset", o_orderdate AS ts,
  CASE o_orderstatus WHEN 'O' THEN 'RAW' WHEN 'P' THEN 'PENDING_APPROVAL' WHEN 'F' THEN 'APPROVED' END AS status,
  o_orderpriority AS domain, o_totalprice AS score FROM orders)"""

V3 = """v3 AS (SELECT doc_id,
  'doc_' || CAST(doc_id // 6 AS VARCHAR) || CASE WHEN doc_id % 2 = 0 THEN '-value' ELSE '-key' END AS subject,
  CAST(doc_id % 3 + 1 AS INTEGER) AS version, CAST(doc_id + 100001 AS INTEGER) AS schema_id,
  CASE WHEN doc_id % 17 = 0 THEN NULL ELSE source || '.' || lang END AS namespace, source, lang
  FROM documents)"""

V4 = """v4 AS (SELECT event_id AS id, CAST(event_id % 8 AS INTEGER) AS kind, user_id, event_type, value, ts,
  CASE event_id % 8
    WHEN 0 THEN props
    WHEN 1 THEN '```json' || chr(10) || props || chr(10) || '```'
    WHEN 2 THEN '```' || chr(10) || props || chr(10) || '```'
    WHEN 3 THEN '## Analysis' || chr(10) || props
    WHEN 4 THEN props || chr(10) || 'Hope this helps'
    WHEN 5 THEN replace(props, '}', ',}')
    WHEN 6 THEN replace(props, '}', chr(10) || '  "m": ' || CAST(user_id AS VARCHAR) || '}')
    ELSE replace(props, '"', '''') END AS text
  FROM events)"""

V5 = """v5 AS (SELECT source || '/' || CAST(doc_id AS VARCHAR) AS path, lang AS type, text AS content FROM documents
  UNION ALL SELECT url AS path, 'html' AS type, html AS content FROM pages)"""

V6 = """v6_scope AS (SELECT CAST(user_id AS VARCHAR) AS idea_id, event_id AS "offset",
    'scope-' || CAST(event_id AS VARCHAR) AS challenge_id, value, ts FROM events WHERE event_type = 'click'),
  v6_time AS (SELECT CAST(user_id AS VARCHAR) AS idea_id, event_id AS "offset",
    'time-' || CAST(event_id AS VARCHAR) AS challenge_id, value, ts FROM events WHERE event_type = 'view'),
  v6_cost AS (SELECT CAST(user_id AS VARCHAR) AS idea_id, event_id AS "offset",
    'cost-' || CAST(event_id AS VARCHAR) AS challenge_id, value, ts FROM events WHERE event_type = 'purchase')"""

V7 = """v7 AS (SELECT *, 'g' || CAST(user_id % 7 AS VARCHAR) AS "group" FROM v1)"""

ALL = {"v1": V1, "v2": V2, "v3": V3, "v4": V4, "v5": V5, "v6": V6, "v7": V7}
NEEDS = {"v7": ["v1"]}


def with_views(sql: str, *views: str) -> str:
    """Prefix ``sql`` (which starts with SELECT or continues a WITH list via ', name AS')
    with the CTE definitions of ``views`` (dependencies added in order)."""
    order: list[str] = []
    for v in views:
        for dep in NEEDS.get(v, []) + [v]:
            if dep not in order:
                order.append(dep)
    body = sql.strip()
    ctes = ",\n".join(ALL[v] for v in order)
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
