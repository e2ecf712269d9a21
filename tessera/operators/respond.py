"""Bulk request → response with a caller-supplied function (UDF-1, UDF-2).

The responder sees Arrow batches as pandas Series (one call per batch, not per row).
A failing batch or row yields a NULL response with the error text, which the record
builders then turn into their fallback rows.  Without a responder every row gets a
NULL response (the deterministic fallback path, UDF-2).
"""

from __future__ import annotations

from typing import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Responder = Callable[[pd.Series, pd.Series], pd.Series]


def respond(prompts: DataFrame, fn: Responder | None, id_col: str = "id",
            prompt: str = "prompt", system: str = "system") -> DataFrame:
    """(id, prompt[, system]) → (id, response, error)."""
    has_system = system in prompts.columns
    base = prompts.select(F.col(id_col).alias("id"), F.col(prompt).alias("prompt"),
                          (F.col(system) if has_system else F.lit("")).alias("system"))
    if fn is None:
        return base.select("id", F.lit(None).cast("string").alias("response"),
                           F.lit("no responder").alias("error"))
    id_type = prompts.schema[id_col].dataType.simpleString()

    def call(batches):
        for pdf in batches:
            try:
                out = pd.Series(fn(pdf["prompt"], pdf["system"]), index=pdf.index, dtype=object)
                err = out.isna().map(lambda missing: "no response" if missing else None)
            except Exception as e:  # noqa: BLE001 - any responder failure becomes fallback rows
                out = pd.Series([None] * len(pdf), index=pdf.index, dtype=object)
                err = pd.Series([f"{type(e).__name__}: {e}"] * len(pdf), index=pdf.index)
            yield pd.DataFrame({"id": pdf["id"], "response": out, "error": err})

    return base.mapInPandas(call, f"id {id_type}, response string, error string")
