"""PIPE-1 as a chain of streams: stages joined by their logs.

Each stage reads the log of the one before, keeps the records that its gate lets through,
builds its own records and appends them to its log under ``root/<name>``.  Every stage has its
own checkpoint, so a chain that stops anywhere goes on where it stopped (STM-11), and
records that arrive later pass through all stages.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from tessera.sources.log import read_or_empty, stream_log


@dataclass(frozen=True)
class Stage:
    """``build`` maps the records that ``gate`` keeps to this stage's records."""

    name: str
    build: Callable[[DataFrame], DataFrame]
    gate: Column | None = None


def schemas(spark: SparkSession, schema, stages: list[Stage]) -> list:
    """Input schema of each stage, and the last one's output: from the builders alone, no data is read."""
    out = [schema]
    for stage in stages:
        rows = spark.createDataFrame([], out[-1])
        out.append(stage.build(rows if stage.gate is None else rows.filter(stage.gate)).schema)
    return out


def run_chain(spark: SparkSession, source: str, schema, stages: list[Stage], root: str, upto: str | None = None) -> None:
    """Drain ``source`` through the stages, one after the other; ``upto`` names the last one to run."""
    inputs = schemas(spark, schema, stages)
    before = source
    for stage, given in zip(stages, inputs):
        rows = stream_log(spark, before, given)
        rows = rows if stage.gate is None else rows.filter(stage.gate)
        query = (stage.build(rows).writeStream.format("parquet").option("path", f"{root}/{stage.name}").outputMode("append")
                 .option("checkpointLocation", f"{root}/_checkpoints/{stage.name}").trigger(availableNow=True).start())
        query.awaitTermination()
        if stage.name == upto:
            return
        before = f"{root}/{stage.name}"


def read_stage(spark: SparkSession, root: str, name: str, schema) -> DataFrame:
    """The log of a stage (empty before its first run)."""
    return read_or_empty(spark, f"{root}/{name}", schema, "parquet")
