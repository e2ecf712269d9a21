"""SRC-4: folders with one pretty-printed JSON document per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_json_docs(spark: SparkSession, pattern: str, schema: StructType | str,
                   with_file: bool = True) -> DataFrame:
    """Scan ``pattern`` (a glob such as ``/dir/scope_*.json``) with a fixed schema.

    Files are indented JSON, so ``multiLine`` is required; the file name is kept
    (``_file``) because the reference orders and de-duplicates documents by it.
    """
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    df = spark.read.schema(st).option("multiLine", True).option("mode", "PERMISSIVE").json(pattern)
    return df.withColumn("_file", F.input_file_name()) if with_file else df
