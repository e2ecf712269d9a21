"""Writers: keyed log append (SNK-1), keyed JSON documents (SNK-2), artifacts (SNK-3),
streaming upsert (SNK-4, in ``tessera.streaming``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.artifacts import write_artifacts  # noqa: F401  (SNK-3)
from tessera.operators.log import latest_per_key
from tessera.operators.sequence import number_sampled
from tessera.schemas import DEFAULT_PARTITIONS
from tessera.session import scratch_path
from tessera.sources.docs import read_json_docs
from tessera.sources.log import read_or_empty


def envelope(df: DataFrame, topic: str, key_col: str) -> DataFrame:
    """SNK-1 payload: (topic, key, value) with the whole record as compact JSON text."""
    return df.select(F.lit(topic).alias("topic"), F.col(key_col).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def publish(df: DataFrame, topic: str, key_col: str, target: str, kind: str = "parquet",
            options: dict | None = None) -> None:
    """SNK-1: append records to a topic.

    Kafka (``kind='kafka'``, ``target`` = bootstrap servers) assigns offsets itself.
    The file log gets ``ts`` = write time, ``partition`` (of the key's hash) and an
    ``offset`` that grows from write to write: a write continues after the highest offset
    of the topic's newest date folder, so every latest/first operator orders a published
    log by its default.  One writer a topic at a time.  The records are written to the
    checkpoint folder once, then cut into equi-depth ranges of the key, so no task numbers
    a whole topic.  Folders are ``topic=…/date=…`` (the
    day of ``ts`` in the session time zone, UTC in this library's sessions), so a topic
    filter and a retention bound skip whole folders.
    Failures raise (no silent False)."""
    env = envelope(df, topic, key_col)
    if kind == "kafka":
        w = env.write.format("kafka").option("kafka.bootstrap.servers", target).option("topic", topic)
        for k, v in (options or {}).items():
            w = w.option(k, v)
        w.save()
        return
    staged = scratch_path(df.sparkSession, "publish")
    env.write.parquet(staged)
    env = df.sparkSession.read.schema(env.schema).parquet(staged)
    now = F.current_timestamp()
    start = _next_offset(df.sparkSession, topic, target, kind)
    (number_sampled(env, ["key"], name="_no")
        .withColumn("ts", now)
        .withColumn("date", F.to_date(now))
        .withColumn("partition", F.pmod(F.xxhash64("key"), F.lit(DEFAULT_PARTITIONS)).cast("int"))
        .withColumn("offset", F.col("_no") + F.lit(start - 1)).drop("_no")
        .write.mode("append").partitionBy("topic", "date").format(kind).save(target))


def _next_offset(spark: SparkSession, topic: str, target: str, kind: str) -> int:
    """The offset after the last one of a topic's file log (folder names find its newest day)."""
    schema = "topic STRING, date DATE, offset BIGINT"
    log = read_or_empty(spark, target, schema, kind).filter(F.col("topic") == topic)
    day = log.agg(F.max("date")).first()[0]
    if day is None:
        return 0
    return (log.filter(F.col("date") == day).agg(F.max("offset")).first()[0] or 0) + 1


def write_json_docs(spark: SparkSession, new: DataFrame, base: str, current: str | None,
                    id_col: str, order: str) -> str:
    """SNK-2: keyed overwrite — one document per id; rewriting an id replaces it.

    Old snapshot ∪ new rows → newest per id (``order``) → written to a *new* snapshot
    folder (never overwriting the folder being read); returns its path."""
    import uuid

    old = read_or_empty(spark, current, new.schema) if current else spark.createDataFrame([], new.schema)
    merged = latest_per_key(old.unionByName(new), id_col, order, value=None)
    path = f"{base.rstrip('/')}/snapshot-{uuid.uuid4().hex[:12]}"
    merged.write.mode("error").json(path)
    return path


def write_json_parts(df: DataFrame, folder: str, order: list[str], by: list[str] = (), per_document: int = 1000) -> DataFrame:
    """SNK-2 in bulk: pretty-printed JSON documents of at most ``per_document`` records each, in folders of ``by``.

    Records are numbered inside their folder over sampled ranges, so the number of documents
    grows with the records and no array does.  Returns the index of the written documents:
    ``by``, ``_file``, ``records``, and the first and last value of the first ``order`` column.
    """
    by, order = list(by), list(order)
    fields = [c for c in df.columns if c not in by]
    part = F.floor((F.col("_no") - 1) / per_document)
    rec = F.struct(F.col("_no").alias("no"), F.struct(*by, *fields).alias("rec"))
    doc = (number_sampled(df, order, by, name="_no").groupBy(*by, part.alias("_part"))
           .agg(F.array_sort(F.collect_list(rec)).alias("docs"))
           .select(*by, F.to_json(F.transform("docs", lambda d: d["rec"]), {"pretty": "true"}).alias("value")))
    # one row a file: a document is a file
    w = doc.write.option("maxRecordsPerFile", 1)
    (w.partitionBy(*by) if by else w).text(folder)
    written = read_json_docs(df.sparkSession, folder + "/*" * len(by) + "/*.txt", df.select(*by, *fields).schema)
    return written.groupBy(*by, "_file").agg(F.count(F.lit(1)).alias("records"), F.min(order[0]).alias("first"),
                                             F.max(order[0]).alias("last"))
