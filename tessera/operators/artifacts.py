"""Nested artifacts and roll-ups over nested arrays (SNK-3, AGG-13, AGG-19, AGG-20, SRT-8).

Roll-ups run per record with higher-order functions (``aggregate``/``transform``),
so they need neither an explode nor a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import line_count


def explode_artifacts(df: DataFrame, artifacts: str = "artifacts",
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """SNK-3: nested artifacts array → one (path, type, content, description) row each."""
    return df.select(*keep, F.explode(F.col(artifacts)).alias("_a")).select(*keep, "_a.*")


def write_artifacts(rows: DataFrame, path: str, mode: str = "append") -> None:
    """SNK-3 sink: artifact rows written partitioned by type (never into a checkout)."""
    rows.write.mode(mode).partitionBy("type").parquet(path)


def artifact_totals(rows: DataFrame, by: tuple[str, ...] = ("type",), content: str = "content") -> DataFrame:
    """AGG-13: files generated and total lines (per type)."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("files"),
                                 F.sum(line_count(F.col(content))).alias("total_lines"))


def cost_rollup(breakdown: Column | str, amount: str = "monthly_usd") -> Column:
    """AGG-19: monthly total over a nested breakdown array (NULL amounts count 0)."""
    b = F.col(breakdown) if isinstance(breakdown, str) else breakdown
    return F.aggregate(b, F.lit(0.0), lambda acc, x: acc + F.coalesce(x[amount], F.lit(0.0)))


def effort_rollup(resources: Column | str, count: str = "count",
                  duration: str = "duration_weeks") -> Column:
    """AGG-20: person-weeks = Σ count × duration (phase total: Σ weeks with count=1)."""
    r = F.col(resources) if isinstance(resources, str) else resources
    return F.aggregate(r, F.lit(0.0), lambda acc, x: acc + F.coalesce(x[count], F.lit(1.0))
                       * F.coalesce(x[duration], F.lit(0.0)))


def annualised(monthly: Column, years: int) -> Column:
    """SCL-24 over a rolled-up month: total over ``years``."""
    return monthly * F.lit(12 * years)


def ordered_steps(steps: Column | str) -> Column:
    """SRT-8: deployment steps sorted by their ``order`` field (then description)."""
    s = F.col(steps) if isinstance(steps, str) else steps
    return F.array_sort(s, lambda a, b: F.when(a["order"] < b["order"], -1)
                        .when(a["order"] > b["order"], 1).otherwise(0))
