"""Tool listings and schema-registry listings turned into rows (SRC-6, SRC-7, WIN-5)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import col_, strip_ws

# --- fixed values: listing markers ---
TOPICS_MARKER = "Kafka topics:"
CONNECTORS_MARKER = "Active Connectors:"
REGISTRY_TYPE = "map<string, array<struct<version: int, id: int, schema: string>>>"


def _after_marker(text: Column, marker: str) -> Column:
    """Text between the first and the second occurrence of ``marker`` (or to the end)."""
    return F.element_at(F.split(text, re.escape(marker).replace("\\ ", " "), -1), 2)


def listing_names(text, marker: str = TOPICS_MARKER, strip_quotes: bool = False) -> Column:
    """Names after ``marker``: split on ',', trimmed, empties dropped (NULL when no marker)."""
    t = col_(text)
    body = strip_ws(_after_marker(t, marker))
    if strip_quotes:
        body = F.regexp_replace(body, '^"+|"+$', "")
    names = F.filter(F.transform(F.split(body, ","), lambda x: strip_ws(x)), lambda x: x != "")
    return F.when(t.contains(marker), names)


def parse_listing(df: DataFrame, col: str, marker: str = TOPICS_MARKER,
                  name: str = "name", keep: tuple[str, ...] = ()) -> DataFrame:
    """SRC-6: one row per listed name, with its position in the listing."""
    return df.select(*keep, F.posexplode(listing_names(F.col(col), marker)).alias("position", name))


def parse_connectors(df: DataFrame, col: str, marker: str = CONNECTORS_MARKER,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """SRC-6 (connectors): quotes stripped, every connector a RUNNING source."""
    return (df.select(*keep, F.posexplode(listing_names(F.col(col), marker, strip_quotes=True))
                      .alias("position", "name"))
            .withColumn("type", F.lit("source")).withColumn("status", F.lit("RUNNING")))


def parse_registry(df: DataFrame, col: str, mode: str = "latest",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """SRC-7 + WIN-5: registry listing (subject → versions) → one schema row per subject.

    ``mode="first"`` takes element 0 as the reference does (it assumes the
    listing puts the newest first); the default takes the highest version.
    Namespace comes from the embedded schema text; bad text → NULL.
    """
    entries = df.select(*keep, F.explode(F.from_json(F.col(col), REGISTRY_TYPE)).alias("subject", "versions"))
    entries = entries.filter(F.size("versions") > 0)
    if mode == "first":
        pick = F.element_at("versions", 1)
    else:
        pick = F.reduce("versions", F.element_at("versions", 1),
                        lambda acc, x: F.when(F.coalesce(x.version, F.lit(1)) >
                                              F.coalesce(acc.version, F.lit(1)), x).otherwise(acc))
    v = entries.withColumn("_v", pick)
    return v.select(
        *keep, "subject",
        F.coalesce(F.col("_v.version"), F.lit(1)).alias("version"),
        F.coalesce(F.col("_v.id"), F.lit(0)).alias("schema_id"),
        F.lit("AVRO").alias("schema_type"),
        F.get_json_object(F.col("_v.schema"), "$.namespace").alias("namespace"))


def explode_json(df: DataFrame, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """SRC-7 / SCL-15 without a schema: one row for each member of a JSON text of any shape.

    Gives ``keep``, ``shape`` of the text (object, array, string, number, boolean, null, or
    bad), ``pos`` and ``name`` of the member (no name in an array), its ``kind`` and its
    ``value`` as JSON text.  Texts without members, bad ones included, give one row.
    """
    parsed = df.select(*keep, F.try_parse_json(text).alias("_v"))
    tvf = df.sparkSession.tvf

    def kind(v: Column) -> Column:
        name = F.schema_of_variant(v)
        return (F.when(name.startswith("OBJECT"), "object").when(name.startswith("ARRAY"), "array")
                .when(name == "STRING", "string").when(name == "BOOLEAN", "boolean").when(name == "VOID", "null")
                .when(name.isNotNull(), "number"))

    members = parsed.lateralJoin(tvf.variant_explode_outer(F.col("_v").outer()))
    return members.select(*keep, F.coalesce(kind(F.col("_v")), F.lit("bad")).alias("shape"), "pos", F.col("key").alias("name"),
                          kind(F.col("value")).alias("kind"), F.to_json("value").alias("value"))
