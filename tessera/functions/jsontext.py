"""Semi-structured response handling as Column expressions (SCL-5..9, 14, 15, 17, 21).

All of it runs JVM-side inside whole-stage codegen; there is no Python UDF.
Validity of a candidate text is tested the way a strict JSON parser would see it:
the text wrapped in ``[...]`` must parse as an array holding exactly one object.
That rejects trailing commas, text after the object, two objects, single quotes,
raw control characters in strings, bare arrays and cut-off text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import col_, strip_ws

__all__ = [
    "with_extracted", "with_repaired", "with_parsed",
    "strip_fences", "between_fences", "extract_object", "is_json_object", "repair_json",
    "repair_kind", "parse_or_fallback", "encode_json", "json_field", "connector_label",
    "to_score", "FENCE_JSON", "FENCE",
]

# --- fixed values: markers and repair patterns ---
FENCE_JSON = "```json"
FENCE = "```"
# a value end ('"', digit, '}', ']' or any letter of true/false/null — it is a
# character class) followed by a line break and the next quoted key: insert ','
MISSING_COMMA = r'(["\d\}\]true|false|null])\s*\n\s*"'
MISSING_COMMA_FIX = '$1,\n  "'
# ',' directly before a closing brace or bracket: drop it
TRAILING_COMMA = r",(\s*[}\]])"
TRAILING_COMMA_FIX = "$1"
PARSE_ERROR = "Failed to parse or repair JSON"


def _after(text: Column, marker: str) -> Column:
    """Text after the first occurrence of ``marker`` (caller checks it occurs)."""
    return F.substr(text, F.instr(text, marker) + F.lit(len(marker)))


def _before(text: Column, marker: str) -> Column:
    """Text before the first occurrence of ``marker``, or all of it."""
    return F.substring_index(text, marker, 1)


def strip_fences(text) -> Column:
    """SCL-5: trim; drop a leading ```json, then a leading ```, then a trailing ```; trim."""
    t = strip_ws(text)
    t = F.when(t.startswith(FENCE_JSON), F.substr(t, F.lit(len(FENCE_JSON) + 1))).otherwise(t)
    t = F.when(t.startswith(FENCE), F.substr(t, F.lit(len(FENCE) + 1))).otherwise(t)
    t = F.when(t.endswith(FENCE),
               F.substr(t, F.lit(1), F.length(t) - F.lit(len(FENCE)))).otherwise(t)
    return strip_ws(t)


def between_fences(text) -> Column:
    """SCL-6: the inside of the first ```json block, else of the first ``` block, else all; trimmed."""
    t = col_(text)
    inner = (F.when(t.contains(FENCE_JSON), _before(_after(t, FENCE_JSON), FENCE))
             .when(t.contains(FENCE), _before(_after(t, FENCE), FENCE))
             .otherwise(t))
    return strip_ws(inner)


def _let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times in ``body`` (a one-element
    ``transform``): keeps chained rules linear instead of duplicating sub-trees."""
    return F.element_at(F.transform(F.array(value), body), 1)


def extract_object(text) -> Column:
    """SCL-7: cut a response down to its JSON object.

    1. trim; 2. if it holds ```json and a closing fence after it, keep the inside;
    else if it starts with ``` and has another ```, keep from the first line break to
    the next fence; 3. cut to the first '{' unless it starts with one; 4. cut after
    the last '}' unless it ends with one.  (``with_extracted`` is the staged form
    for whole DataFrames; both give the same result.)
    """
    def step2(t):
        j_start = F.instr(t, FENCE_JSON) + F.lit(len(FENCE_JSON))
        t_json = _let(F.instr(F.substr(t, j_start), FENCE), lambda jr: F.when(
            jr > 0, strip_ws(F.substr(t, j_start, jr - F.lit(1)))).otherwise(t))
        nl = F.instr(t, "\n")
        g_start = F.when(nl > 0, nl + F.lit(1)).otherwise(F.lit(1))
        t_gen = _let(F.instr(F.substr(t, g_start), FENCE), lambda gr: F.when(
            gr > 0, strip_ws(F.substr(t, g_start, gr - F.lit(1)))).otherwise(t))
        has_second = F.instr(F.substr(t, F.lit(len(FENCE) + 1)), FENCE) > 0
        return (F.when(t.contains(FENCE_JSON), t_json)
                .when(t.startswith(FENCE) & has_second, t_gen).otherwise(t))

    def step3(t):
        first = F.instr(t, "{")
        return F.when(~t.startswith("{") & (first > 0), F.substr(t, first)).otherwise(t)

    def step4(t):
        last_from_end = F.instr(F.reverse(t), "}")
        return F.when(~t.endswith("}") & (last_from_end > 0),
                      F.substr(t, F.lit(1), F.length(t) - last_from_end + F.lit(1))).otherwise(t)

    return _let(_let(_let(strip_ws(col_(text)), step2), step3), step4)


def is_json_object(text) -> Column:
    """True when ``text`` is exactly one strict JSON object (NULL text → False).

    Read as the only element of an array it must be one non-null object; a text with a
    ``]`` must also read as the only field of an object, which rules out texts that close
    the array and open another one."""
    strict = {"allowSingleQuotes": "false", "allowNumericLeadingZeros": "false"}
    t = col_(text)
    parsed = F.from_json(F.concat(F.lit("["), t, F.lit("]")), "array<map<string,string>>", strict)
    inner = F.from_json(F.concat(F.lit('{"v":'), t, F.lit("}")), "v map<string,string>", strict)
    one = (F.size(parsed) == 1) & F.get(parsed, F.lit(0)).isNotNull()
    return F.coalesce(one & (~t.contains("]") | inner["v"].isNotNull()), F.lit(False))


def _repair(text: Column, label: bool) -> Column:
    def body(t):
        def with_commas(c):
            trailing = F.regexp_replace(t, TRAILING_COMMA, TRAILING_COMMA_FIX)
            both = F.regexp_replace(c, TRAILING_COMMA, TRAILING_COMMA_FIX)
            return (F.when(is_json_object(t), F.lit("as_is") if label else t)
                    .when(is_json_object(c), F.lit("commas") if label else c)
                    .when(is_json_object(trailing), F.lit("trailing") if label else trailing)
                    .when(is_json_object(both), F.lit("both") if label else both)
                    .otherwise(F.lit("none") if label else F.lit(None).cast("string")))
        return _let(F.regexp_replace(t, MISSING_COMMA, MISSING_COMMA_FIX), with_commas)
    return _let(text, body)


def repair_json(text) -> Column:
    """SCL-8: first candidate that is a strict JSON object wins; NULL when none is.

    Order: as-is → insert missing commas → drop trailing commas → both.
    """
    return _repair(col_(text), label=False)


def repair_kind(text) -> Column:
    """Which repair made ``text`` parse: as_is / commas / trailing / both / none."""
    return _repair(col_(text), label=True)


def parse_or_fallback(text, schema: str, fallback: Column | None = None) -> Column:
    """SCL-9: extract + repair + typed parse; else ``fallback``; else an error struct.

    Without a fallback the result is ``struct<ok, parsed, error, raw_response_preview>``.
    """
    t = col_(text)

    def body(repaired):
        parsed = F.from_json(repaired, schema)
        if fallback is not None:
            return F.when(repaired.isNotNull(), parsed).otherwise(fallback)
        return F.struct(
            repaired.isNotNull().alias("ok"),
            parsed.alias("parsed"),
            F.when(repaired.isNull(), F.lit(PARSE_ERROR)).alias("error"),
            F.when(repaired.isNull(), F.coalesce(F.substring(t, 1, 500), F.lit(""))).alias(
                "raw_response_preview"))
    return _let(repair_json(extract_object(t)), body)


def encode_json(c) -> Column:
    """SCL-14: nested value → compact JSON text (key order = schema order)."""
    return F.to_json(col_(c))


def json_field(text, path: str) -> Column:
    """SCL-15: one field of embedded JSON text; NULL on bad text."""
    return F.get_json_object(col_(text), path)


def connector_label(x) -> Column:
    """SCL-17: plain string as is; a JSON object → its 'type', else 'name', else its text."""
    c = col_(x)
    return F.coalesce(F.get_json_object(c, "$.type"), F.get_json_object(c, "$.name"), c)


def to_score(x, strict: bool = False) -> Column:
    """SCL-21: numeric cast; ``strict`` raises on bad input (ANSI), else NULL."""
    c = col_(x)
    return c.cast("double") if strict else c.try_cast("double")


# ----------------------------------------------------------------------------
# Staged (DataFrame-level) forms.  Each step is its own projection, so a text is
# referenced once per step instead of once per path through a nested expression
# tree (the Column forms above duplicate sub-expressions and grow exponentially
# when chained).  Catalyst keeps the projections apart because collapsing them
# would duplicate non-cheap expressions.

def with_extracted(df, text: str, out: str = "extracted"):
    """SCL-7 as stages: adds ``out`` = the response cut down to its JSON object."""
    t = F.col("_ex_t")
    d = df.withColumn("_ex_t", strip_ws(F.col(text)))
    j_start = F.instr(t, FENCE_JSON) + F.lit(len(FENCE_JSON))
    nl = F.instr(t, "\n")
    g_start = F.when(nl > 0, nl + F.lit(1)).otherwise(F.lit(1))
    d = d.withColumn("_ex_js", j_start).withColumn("_ex_gs", g_start)
    d = d.withColumn("_ex_jr", F.instr(F.substr(t, F.col("_ex_js")), FENCE)) \
         .withColumn("_ex_gr", F.instr(F.substr(t, F.col("_ex_gs")), FENCE))
    t_json = F.when(F.col("_ex_jr") > 0,
                    strip_ws(F.substr(t, F.col("_ex_js"), F.col("_ex_jr") - F.lit(1)))).otherwise(t)
    t_gen = F.when(F.col("_ex_gr") > 0,
                   strip_ws(F.substr(t, F.col("_ex_gs"), F.col("_ex_gr") - F.lit(1)))).otherwise(t)
    has_second = F.instr(F.substr(t, F.lit(len(FENCE) + 1)), FENCE) > 0
    d = d.withColumn("_ex_2", F.when(t.contains(FENCE_JSON), t_json)
                     .when(t.startswith(FENCE) & has_second, t_gen).otherwise(t))
    t2 = F.col("_ex_2")
    first = F.instr(t2, "{")
    d = d.withColumn("_ex_3", F.when(~t2.startswith("{") & (first > 0), F.substr(t2, first)).otherwise(t2))
    t3 = F.col("_ex_3")
    last_from_end = F.instr(F.reverse(t3), "}")
    d = d.withColumn(out, F.when(~t3.endswith("}") & (last_from_end > 0),
                                 F.substr(t3, F.lit(1), F.length(t3) - last_from_end + F.lit(1)))
                     .otherwise(t3))
    return d.drop("_ex_t", "_ex_js", "_ex_gs", "_ex_jr", "_ex_gr", "_ex_2", "_ex_3")


def with_repaired(df, col: str, out: str = "repaired", kind: str | None = None):
    """SCL-8 as stages: adds ``out`` (first strict-object candidate or NULL) and, when
    ``kind`` is given, which repair made it parse."""
    c = F.col(col)
    ok = [f"_rp_ok{i}" for i in range(4)]
    names = [("as_is", col), ("commas", "_rp_1"), ("trailing", "_rp_2"), ("both", "_rp_3")]
    # a repair candidate is only built (and parsed) when every earlier one failed
    d = df.withColumn(ok[0], is_json_object(c))
    builders = [None,
                lambda: F.regexp_replace(c, MISSING_COMMA, MISSING_COMMA_FIX),
                lambda: F.regexp_replace(c, TRAILING_COMMA, TRAILING_COMMA_FIX),
                lambda: F.regexp_replace(F.col("_rp_1"), TRAILING_COMMA, TRAILING_COMMA_FIX)]
    failed = ~F.col(ok[0])
    for i in range(1, 4):
        # '_rp_1' exists whenever the as-is text failed, so 'both' can start from it
        d = d.withColumn(names[i][1], F.when(failed, builders[i]()))
        d = d.withColumn(ok[i], F.when(failed, is_json_object(F.col(names[i][1]))).otherwise(F.lit(False)))
        failed = failed & ~F.col(ok[i])
    res = F.lit(None).cast("string")
    lab = F.lit("none")
    for i in reversed(range(4)):
        res = F.when(F.col(ok[i]), F.col(names[i][1])).otherwise(res)
        lab = F.when(F.col(ok[i]), F.lit(names[i][0])).otherwise(lab)
    d = d.withColumn(out, res)
    if kind:
        d = d.withColumn(kind, lab)
    return d.drop("_rp_1", "_rp_2", "_rp_3", *ok)


def with_parsed(df, text: str, schema: str, out: str = "parsed", fallback=None,
                error: bool = True):
    """SCL-9 as stages: extract + repair + typed parse.

    Adds ``out`` (the typed struct, or ``fallback`` when nothing parses) and, with
    ``error``, ``parse_error`` / ``raw_response_preview`` for rows that failed."""
    d = with_repaired(with_extracted(df, text, "_pf_x"), "_pf_x", "_pf_r")
    ok = F.col("_pf_r").isNotNull()
    parsed = F.from_json(F.col("_pf_r"), schema)
    d = d.withColumn(out, F.when(ok, parsed).otherwise(fallback) if fallback is not None
                     else F.when(ok, parsed))
    if error:
        d = (d.withColumn("parse_error", F.when(~ok, F.lit(PARSE_ERROR)))
              .withColumn("raw_response_preview",
                          F.when(~ok, F.coalesce(F.substring(F.col(text), 1, 500), F.lit("")))))
    return d.withColumn("parse_ok", ok).drop("_pf_x", "_pf_r")
