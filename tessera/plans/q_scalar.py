"""Scalar function queries (SCL-*, SRT-6) over the dimension tables and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import jsontext as J
from tessera.functions import text as X
from tessera.plans import oracle_text as T
from tessera.plans.registry import query


@query("text_rules", "SCL-3 SCL-4 SCL-22", sql="""
SELECT p_partkey, replace(replace(lower(p_name), ' ', '-'), '/', '-') AS slug,
  replace(lower(p_name), ' ', '-') AS slug_keep_slash,
  translate(lower(p_type), '. -', '___') AS ident,
  replace(translate(lower(p_type), ' ', '_'), '_', '-') AS account,
  lower(trim(p_brand)) AS choice, upper(trim(p_type)) AS upper_choice
FROM part
""")
def text_rules(v):
    """Slugs, identifiers, account names and normalised choices."""
    p = v.t.part
    return p.select(
        "p_partkey", X.slug("p_name").alias("slug"), X.slug("p_name", keep_slash=True).alias("slug_keep_slash"),
        X.safe_ident(F.translate(F.lower("p_type"), " ", "_")).alias("ident"),
        X.account_name(F.translate(F.lower("p_type"), " ", "_")).alias("account"),
        X.normalise_choice("p_brand").alias("choice"), X.normalise_upper("p_type").alias("upper_choice"))


@query("list_rules", "SCL-10 SCL-16 SCL-23 SRT-6", sql="""
WITH w AS (SELECT p_partkey, replace(p_name, ' ', ', ') || ',, ' AS csv, string_split(p_type, ' ') AS words FROM part)
SELECT p_partkey,
  CAST(len(list_filter(list_transform(string_split(csv, ','), lambda x: trim(x)), lambda x: x <> '')) AS INTEGER) AS listed,
  CAST(len(string_split(csv, ',')) AS INTEGER) AS edited,
  array_to_string(CASE WHEN len(words) > 2 THEN list_concat(words[1:2], ['...']) ELSE words END, ', ') AS head,
  len(words) > 0 AS truthy
FROM w
""")
def list_rules(v):
    """Comma lists (listing drops empties, edit keeps them), head of an array with '...',
    joined lists, non-empty test."""
    p = v.t.part.select("p_partkey", F.concat(F.replace("p_name", F.lit(" "), F.lit(", ")), F.lit(",, ")).alias("csv"),
                        F.split("p_type", " ").alias("words"))
    return p.select("p_partkey", F.size(X.csv_list("csv")).alias("listed"),
                    F.size(X.csv_list("csv", drop_empty=False)).alias("edited"),
                    X.join_list(X.head_of_array("words", 2, "...")).alias("head"),
                    X.is_truthy("words").alias("truthy"))


@query("previews_and_lines", "SCL-11 SCL-18", sql="""
SELECT doc_id, CASE WHEN length(text) > 50 THEN left(text, 50) || '...' ELSE text END AS preview,
  left(text, 8) AS cut, CAST(len(string_split(text, chr(10))) AS INTEGER) AS lines FROM documents
""")
def previews_and_lines(v):
    """Previews (50 + '...', plain 8-char cut) and line counts of whole documents."""
    d = v.t.documents
    return d.select("doc_id", X.preview("text", 50, ellipsis=True).alias("preview"),
                    X.preview("text", 8).alias("cut"), X.line_count("text").alias("lines"))


@query("money_and_ranges", "SCL-19 SCL-24 SCL-25", sql="""
SELECT o_orderkey, format('{:,.0f}', o_totalprice) AS money,
  '$' || format('{:,.0f}', o_totalprice * 0.8) || ' - $' || format('{:,.0f}', o_totalprice * 1.2) AS money_range,
  round(o_totalprice / 12 * 12 * 5, 2) AS five_years
FROM orders
""")
def money_and_ranges(v):
    """Money with thousands separators, money ranges, annualised totals."""
    o = v.t.orders
    return o.select("o_orderkey", X.fmt_money("o_totalprice").alias("money"),
                    X.money_range_label(F.col("o_totalprice") * 0.8, F.col("o_totalprice") * 1.2).alias("money_range"),
                    F.round(X.annualise(F.col("o_totalprice") / 12, 5), 2).alias("five_years"))


@query("week_ranges", "SCL-25 SCL-19", sql="""
SELECT l_orderkey, l_linenumber, CAST(CAST(l_linenumber AS DOUBLE) AS VARCHAR) || '-' || CAST(l_quantity AS VARCHAR) || ' weeks' AS label,
  format('{:.2f}', l_tax) AS tax
FROM lineitem
""")
def week_ranges(v):
    """'lo-hi weeks' labels from numbers, two-decimal scores."""
    li = v.t.lineitem
    return li.select("l_orderkey", "l_linenumber",
                     X.range_label(F.col("l_linenumber").cast("double"), F.col("l_quantity")).alias("label"),
                     X.fmt_score("l_tax").alias("tax"))


@query("iso_timestamps", "SCL-12", sql="""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS iso, TRUE AS round_trip FROM events
""")
def iso_timestamps(v):
    """Timestamps to ISO-8601 UTC text and back."""
    e = v.t.events
    iso = X.iso_utc("ts")
    return e.select("event_id", iso.alias("iso"),
                    (X.parse_iso(iso).cast("timestamp_ntz") == F.col("ts")).alias("round_trip"))


@query("record_ids", "SCL-13", sql=f"""
SELECT o_orderkey, {T.record_id('', 'o_orderkey', 'o_custkey')} AS record_id FROM orders
""")
def record_ids(v):
    """Reproducible record ids (SHA-256 of the identifying columns)."""
    return v.t.orders.select("o_orderkey", X.record_id("o_orderkey", "o_custkey").alias("record_id"))


@query("json_fields", "SCL-14 SCL-15 SCL-17 SCL-21", sql="""
SELECT event_id, json_extract_string(props, '$.k') AS k_text,
  to_json(struct_pack(event_id := event_id, event_type := event_type)) AS encoded,
  CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN event_type WHEN 2 THEN 'c' || CAST(user_id AS VARCHAR)
    ELSE props END AS label,
  TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS score,
  TRY_CAST(event_type AS DOUBLE) AS bad_score
FROM events
""")
def json_fields(v):
    """Embedded JSON fields, compact JSON encoding, connector labels, numeric casts."""
    e = v.t.events
    raw = (F.when(F.col("event_id") % 4 == 0, F.col("event_type"))
           .when(F.col("event_id") % 4 == 1, F.concat(F.lit('{"type": "'), F.col("event_type"), F.lit('"}')))
           .when(F.col("event_id") % 4 == 2, F.concat(F.lit('{"name": "c'), F.col("user_id").cast("string"), F.lit('"}')))
           .otherwise(F.col("props")))
    k = J.json_field("props", "$.k")
    return e.select("event_id", k.alias("k_text"),
                    J.encode_json(F.struct("event_id", "event_type")).alias("encoded"),
                    J.connector_label(raw).alias("label"),
                    J.to_score(k).alias("score"), J.to_score(F.col("event_type")).alias("bad_score"))
