"""DuckDB expressions mirroring the response-text rules, for oracle SQL only.

DuckDB's ``json_valid`` accepts trailing commas, so "one strict JSON object" is
``json_valid`` + object type + no ',' before a closing bracket (the test texts
carry no such sequence inside strings).
"""

from __future__ import annotations

NL = "chr(10)"


def ws(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def is_object(x: str) -> str:
    return (f"coalesce(CASE WHEN json_valid({x}) THEN json_type({x}) = 'OBJECT' "
            f"AND NOT regexp_matches({x}, ',\\s*[}}\\]]') END, FALSE)")


def strip_fences(x: str) -> str:
    t0 = ws(x)
    t1 = f"CASE WHEN starts_with({t0}, '```json') THEN substr({t0}, 8) ELSE {t0} END"
    t2 = f"CASE WHEN starts_with({t1}, '```') THEN substr({t1}, 4) ELSE {t1} END"
    t3 = f"CASE WHEN suffix({t2}, '```') THEN left({t2}, length({t2}) - 3) ELSE {t2} END"
    return ws(t3)


def between_fences(x: str) -> str:
    return (f"CASE WHEN contains({x}, '```json') THEN {ws(f'split_part(substr({x}, strpos({x}, chr(96)||chr(96)||chr(96)||{chr(39)}json{chr(39)}) + 7), {chr(39)}```{chr(39)}, 1)')}"
            f" WHEN contains({x}, '```') THEN {ws(f'split_part(substr({x}, strpos({x}, {chr(39)}```{chr(39)}) + 3), {chr(39)}```{chr(39)}, 1)')}"
            f" ELSE {ws(x)} END")


def extract_steps(src: str, out: str = "ex") -> str:
    """CTE chain ``{out}_1 .. {out}`` turning column ``text`` of ``src`` into ``obj``."""
    return f"""{out}_a AS (SELECT *, {ws('text')} AS t0 FROM {src}),
{out}_b AS (SELECT *,
    strpos(t0, '```json') + 7 AS js, strpos(t0, {NL}) AS nl FROM {out}_a),
{out}_c AS (SELECT *,
    CASE WHEN js > 7 THEN strpos(substr(t0, js), '```') ELSE 0 END AS je_rel,
    CASE WHEN nl > 0 THEN nl + 1 ELSE 1 END AS gs FROM {out}_b),
{out}_d AS (SELECT *, strpos(substr(t0, gs), '```') AS ge_rel FROM {out}_c),
{out}_e AS (SELECT *, CASE
      WHEN contains(t0, '```json') THEN CASE WHEN je_rel > 0 THEN {ws('substr(t0, js, je_rel - 1)')} ELSE t0 END
      WHEN starts_with(t0, '```') AND contains(substr(t0, 4), '```') THEN
           CASE WHEN ge_rel > 0 THEN {ws('substr(t0, gs, ge_rel - 1)')} ELSE t0 END
      ELSE t0 END AS t2 FROM {out}_d),
{out}_f AS (SELECT *, CASE WHEN NOT starts_with(t2, '{{') AND strpos(t2, '{{') > 0
      THEN substr(t2, strpos(t2, '{{')) ELSE t2 END AS t3 FROM {out}_e),
{out} AS (SELECT *, CASE WHEN NOT suffix(t3, '}}') AND strpos(t3, '}}') > 0
      THEN left(t3, length(t3) - strpos(reverse(t3), '}}') + 1) ELSE t3 END AS obj FROM {out}_f)"""


def repair_steps(src: str, col: str = "obj", out: str = "rp") -> str:
    """CTE chain producing ``repaired`` and ``repair`` (as_is/commas/trailing/both/none)."""
    commas = f"regexp_replace({col}, '([\"\\d\\}}\\]true|false|null])\\s*\\n\\s*\"', '\\1,' || {NL} || '  \"', 'g')"
    return f"""{out}_a AS (SELECT *, {commas} AS c_commas,
    regexp_replace({col}, ',(\\s*[}}\\]])', '\\1', 'g') AS c_trailing FROM {src}),
{out}_b AS (SELECT *, regexp_replace(c_commas, ',(\\s*[}}\\]])', '\\1', 'g') AS c_both FROM {out}_a),
{out} AS (SELECT *,
    CASE WHEN {is_object(col)} THEN {col} WHEN {is_object('c_commas')} THEN c_commas
         WHEN {is_object('c_trailing')} THEN c_trailing WHEN {is_object('c_both')} THEN c_both END AS repaired,
    CASE WHEN {is_object(col)} THEN 'as_is' WHEN {is_object('c_commas')} THEN 'commas'
         WHEN {is_object('c_trailing')} THEN 'trailing' WHEN {is_object('c_both')} THEN 'both' ELSE 'none' END AS repair
  FROM {out}_b)"""


def record_id(prefix: str, *cols: str) -> str:
    parts = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"'{prefix}' || sha256(concat_ws(chr(1), {parts}))"
