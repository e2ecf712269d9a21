"""Registry of named queries: a Spark plan over the test views plus its DuckDB twin.

Each query is ``fn(views) -> DataFrame`` (lazy).  ``sql`` is the oracle: plain SQL over
the driver tables (the view CTEs are prefixed automatically), or ``None`` when the
operator has no SQL equivalent and is checked against a brute-force fixture instead.
Column names are identical on both sides.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame

from tessera.plans.oracle_views import with_views


@dataclass
class Query:
    name: str
    fn: Callable
    ids: tuple[str, ...]
    sql: str | None
    doc: str = ""
    bench: bool = False
    views: tuple[str, ...] = field(default_factory=tuple)


REGISTRY: dict[str, Query] = {}


def query(name: str, ids: str, sql: str | None = None, views: tuple[str, ...] = (),
          bench: bool = False):
    """Register ``fn(views) -> DataFrame`` under ``name`` for SURVEY ids ``ids``."""

    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        full = with_views(sql, *views) if (sql is not None and views) else sql
        REGISTRY[name] = Query(name, fn, tuple(ids.split()), full, (fn.__doc__ or "").strip(),
                               bench, tuple(views))
        return fn

    return deco


def load_all() -> dict[str, Query]:
    """Import every query module (registration happens on import)."""
    from tessera.plans import (  # noqa: F401
        q_log, q_catalog, q_usage, q_evaluate, q_records, q_review, q_artifacts, q_responses,
        q_scalar, q_stream, q_live)
    return REGISTRY


def run(name: str, spark, sf_dir: str) -> DataFrame:
    from tessera.plans.views import Views

    return load_all()[name].fn(Views(spark, sf_dir))
