"""Log scans (SRC-1, 2, 3, 5, 8).

The default backend is a Parquet log partitioned by ``topic`` with the envelope
columns ``topic, partition, offset, ts, key, value``; a topic filter becomes
partition pruning.  Kafka is used when ``kind="kafka"`` and the connector jar is
on the classpath (it is not in the test image, so that path is untested here).
"""

from __future__ import annotations

import json
from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.errors import AnalysisException

ENVELOPE = ["topic", "partition", "offset", "ts", "key", "value"]


def _kafka_envelope(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("topic"), F.col("partition"), F.col("offset"),
        F.col("timestamp").alias("ts"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"))


#: Offsets by topic and partition: ``{"orders": {0: 120, 1: 95}}``.
Offsets = dict[str, dict[int, int]]


def offsets_json(offsets: Offsets | None, default: str) -> str:
    """Offsets as the Kafka connector takes them."""
    return json.dumps({t: {str(p): o for p, o in ps.items()} for t, ps in offsets.items()}) if offsets else default


def between(starting: Offsets | None, ending: Offsets | None, topics: list[str] | None = None) -> Column:
    """Records from ``starting`` on and before ``ending``; a topic partition that one of them does not name is not
    bounded by it.  With all of ``topics`` named, the offsets reach the scan of the files."""
    keep = F.lit(True)
    for bounds, inside in ((starting, lambda o: F.col("offset") >= o), (ending, lambda o: F.col("offset") < o)):
        if not bounds:
            continue
        others = topics is None or set(topics) - set(bounds)
        found = ~F.col("topic").isin(sorted(bounds)) if others else F.lit(False)
        for topic, parts in sorted(bounds.items()):
            here = ~F.col("partition").isin(sorted(parts))
            for part, at in sorted(parts.items()):
                here = here | ((F.col("partition") == part) & inside(at))
            found = found | ((F.col("topic") == topic) & here)
        keep = keep & found
    return keep


def end_offsets(log: DataFrame) -> Offsets:
    """The offset after the last record of each topic partition: where a bounded read ends, and the next begins.

    One row a topic partition comes to the driver."""
    out: Offsets = {}
    for r in log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end")).collect():
        out.setdefault(r["topic"], {})[r["partition"]] = r["end"]
    return out


def read_log(spark: SparkSession, source: str, topics: Iterable[str] | None = None,
             kind: str = "parquet", options: dict | None = None, starting: Offsets | None = None,
             ending: Offsets | None = None) -> DataFrame:
    """SRC-1: bounded scan of a log, from its earliest record to its current end unless offsets are given.

    ``source`` is a folder (parquet/json) or, for Kafka, the bootstrap servers.  Bounds by
    topic partition (``starting`` included, ``ending`` not) are filters of the file scan, which
    skips topic folders and row groups; Kafka gets them as options and has to get all partitions.
    """
    topics = list(topics) if topics is not None else None
    if kind == "kafka":
        r = (spark.read.format("kafka").option("kafka.bootstrap.servers", source)
             .option("startingOffsets", offsets_json(starting, "earliest"))
             .option("endingOffsets", offsets_json(ending, "latest")))
        r = r.option("subscribe", ",".join(topics)) if topics else r.option("subscribePattern", ".*")
        for k, v in (options or {}).items():
            r = r.option(k, v)
        return _kafka_envelope(r.load())
    df = spark.read.format(kind).options(**(options or {})).load(source)
    if topics is not None:
        df = df.filter(F.col("topic").isin(topics))     # partition pruning on topic=...
    if starting or ending:
        df = df.filter(between(starting, ending, topics))
    return df


def stream_log(spark: SparkSession, source: str, schema: StructType | str | None = None,
               topics: Iterable[str] | None = None, kind: str = "parquet",
               options: dict | None = None) -> DataFrame:
    """SRC-2: the same log, observed continuously (``trigger(availableNow=True)`` drains
    what is there and stops, like the bounded scan).  ``options`` bound what a micro-batch
    takes in: ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``, for Kafka ``maxOffsetsPerTrigger``."""
    topics = list(topics) if topics is not None else None
    if kind == "kafka":
        r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", source)
             .option("startingOffsets", "earliest"))
        r = r.option("subscribe", ",".join(topics)) if topics else r.option("subscribePattern", ".*")
        for k, v in (options or {}).items():
            r = r.option(k, v)
        return _kafka_envelope(r.load())
    r = spark.readStream.format(kind)
    if schema is not None:
        r = r.schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    df = r.load(source)
    if topics is not None:
        df = df.filter(F.col("topic").isin(topics))
    return df


def decode_value(df: DataFrame, schema: StructType | str, value: str = "value",
                 fmt: str = "json", into: str | None = None) -> DataFrame:
    """SRC-3: typed decode of the value with the reader schema.

    ``into`` keeps the record as one struct column; otherwise its fields are
    expanded next to the envelope.  ``fmt="avro"`` needs the spark-avro package.
    """
    if fmt == "avro":
        from pyspark.sql.avro.functions import from_avro  # needs spark-avro on the classpath

        schema_json = schema if isinstance(schema, str) else schema.json()
        rec = from_avro(F.col(value), schema_json)
    else:
        rec = F.from_json(F.col(value), schema)
    if into:
        return df.withColumn(into, rec)
    return df.withColumn("_rec", rec).select(*[c for c in df.columns if c != value], "_rec.*")


def read_topics(spark: SparkSession, sources: dict[str, str], kind: str = "parquet") -> DataFrame:
    """SRC-8: one ingest contract over many topics with different columns.

    ``sources`` maps topic → folder; columns are aligned by name, missing ones NULL.
    """
    out = None
    for topic, path in sources.items():
        df = spark.read.format(kind).load(path).withColumn("topic", F.lit(topic))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def read_or_empty(spark: SparkSession, path: str, schema: StructType | str,
                  kind: str = "json", options: dict | None = None) -> DataFrame:
    """SRC-5: an absent input is an empty typed state, not an error."""
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    try:
        r = spark.read.format(kind).schema(st)
        for k, v in (options or {}).items():
            r = r.option(k, v)
        df = r.load(path)
        df.schema  # noqa: B018 - forces path resolution
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], st)
        raise
