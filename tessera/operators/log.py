"""Keyed message-log semantics: filters, latest/first versions, retention, compaction.

A log is a DataFrame with at least ``key``, ``offset`` and ``value`` columns (names are
parameters).  ``offset`` totally orders the versions of a key; every "latest" or
"first" operator uses it as tie-break, so results never depend on task order.

Latest/first per key are aggregations (``max_by``/``min_by``), not windows: they
combine map-side, so a key holding a third of the log is reduced in parallel
before the shuffle instead of landing whole in one task.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.jsontext import is_json_object
from tessera.operators.sequence import with_previous
from tessera.schemas import COMPACTION_LAG_MS, RETENTION_MS

# ---------------------------------------------------------------- filters (FLT)


def with_status(df: DataFrame, status: str | Iterable[str], col: str = "status") -> DataFrame:
    """FLT-1: keep records in a status (or any of several)."""
    if isinstance(status, str):
        return df.filter(F.col(col) == status)
    return df.filter(F.col(col).isin(list(status)))


def unprocessed(df: DataFrame, col: str = "status",
                done: Iterable[str] = ("APPROVED", "REJECTED")) -> DataFrame:
    """FLT-2: drop items already decided."""
    return df.filter(~F.col(col).isin(list(done)) | F.col(col).isNull())


def by_id(df: DataFrame, id_col: str, value=None) -> DataFrame:
    """FLT-3: point lookup (``value=None`` = any id); pushed to the Parquet scan."""
    return df if value is None else df.filter(F.col(id_col) == F.lit(value))


def drop_tombstones(df: DataFrame, value: str = "value") -> DataFrame:
    """FLT-4: NULL values are skipped, not applied as deletes."""
    return df.filter(F.col(value).isNotNull())


def mark_errors(df: DataFrame, value: str = "value", name: str = "rejected") -> DataFrame:
    """FLT-5: flag values that are not one JSON object (one pass; the scan goes on)."""
    return df.withColumn(name, ~is_json_object(F.col(value)))


def split_errors(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """FLT-5: (good, rejects) of :func:`mark_errors`."""
    marked = mark_errors(df, value, "_rejected")
    return marked.filter(~F.col("_rejected")).drop("_rejected"), marked.filter("_rejected").drop("_rejected")


def check_domain(df: DataFrame, col: str, symbols: Iterable[str]) -> DataFrame:
    """FLT-7: rows whose value is outside the enum's symbols (the violations table)."""
    return df.filter(~F.col(col).isin(list(symbols)) | F.col(col).isNull())


def confidence_between(df: DataFrame, col: str, lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """FLT-8: rows whose score is outside [lo, hi] (violations)."""
    return df.filter(~F.col(col).between(lo, hi) | F.col(col).isNull())


# ------------------------------------------------------ latest / first (WIN, SRT)


def _record(df: DataFrame, exclude: Iterable[str] = ()) -> Column:
    ex = set(exclude)
    return F.struct(*[F.col(c) for c in df.columns if c not in ex])


def latest_in_topic(log: DataFrame, order: str = "offset", value: str = "value",
                    by: Iterable[str] = ()) -> DataFrame:
    """WIN-1: the last non-null value of the whole topic regardless of key.

    ``by`` groups (e.g. per topic); without it the result has at most one row.
    """
    live = drop_tombstones(log, value)
    by = list(by)
    rec = F.max_by(_record(live, by), F.col(order)).alias("_r")
    agg = live.groupBy(*by).agg(rec) if by else live.agg(rec)
    return agg.filter(F.col("_r").isNotNull()).select(*by, "_r.*")


def latest_per_key(log: DataFrame, key: str | list[str] = "key", order: str = "offset",
                   value: str | None = "value") -> DataFrame:
    """WIN-2: compaction view — the newest version of every key (tombstones skipped)."""
    keys = [key] if isinstance(key, str) else list(key)
    live = drop_tombstones(log, value) if value else log
    return (live.groupBy(*keys)
            .agg(F.max_by(_record(live, keys), F.col(order)).alias("_r"))
            .select(*keys, "_r.*"))


def first_per_key(log: DataFrame, key: str | list[str] = "key", order: str = "offset",
                  value: str | None = "value") -> DataFrame:
    """WIN-3 / SRT-3: the first version of every key (or topic) in ``order``."""
    keys = [key] if isinstance(key, str) else list(key)
    live = drop_tombstones(log, value) if value else log
    return (live.groupBy(*keys)
            .agg(F.min_by(_record(live, keys), F.col(order)).alias("_r"))
            .select(*keys, "_r.*"))


def first_per_topic(log: DataFrame, topic: str = "topic", order: str = "offset",
                    value: str = "value") -> DataFrame:
    """SRT-3: demo mode — the first usable record of each topic."""
    return first_per_key(log, topic, order, value)


def most_recent(df: DataFrame, n: int = 1, ts: str = "ts", tiebreak: str = "offset") -> DataFrame:
    """WIN-4 / SRT-2: newest n rows (a top-n: planned as TakeOrderedAndProject)."""
    return df.orderBy(F.col(ts).desc_nulls_last(), F.col(tiebreak).desc()).limit(n)


def newest_first(df: DataFrame, ts: str = "ts", tiebreak: str = "offset") -> DataFrame:
    """SRT-1: ISO text timestamps descending, missing ones last, stable by offset."""
    return df.orderBy(F.coalesce(F.col(ts).cast("string"), F.lit("")).desc(), F.col(tiebreak))


def limit_one(df: DataFrame, ts: str = "ts", tiebreak: str = "offset") -> DataFrame:
    """SRT-2: process a single item (the newest)."""
    return most_recent(df, 1, ts, tiebreak)


def by_name(df: DataFrame, name: str = "id") -> DataFrame:
    """SRT-7: documents in name order."""
    return df.orderBy(F.col(name))


# ------------------------------------------------------ retention / compaction


def _as_of(log: DataFrame, ts: str, as_of) -> Column:
    if as_of is not None:
        return F.lit(as_of).cast("timestamp_ntz") if not isinstance(as_of, Column) else as_of
    # scalar subquery: evaluated once, no join with the log
    return log.agg(F.max(ts)).scalar()


def apply_retention(log: DataFrame, retention_ms: int = RETENTION_MS, ts: str = "ts",
                    topic: str | None = "topic", overrides: dict[str, int] | None = None,
                    as_of=None, date: str | None = None) -> DataFrame:
    """WIN-6: drop records older than the retention of their topic (-1 = keep forever).

    A record without a timestamp cannot have expired and is kept.
    The clock is ``as_of`` (a literal or Column) or, by default, the newest
    record of the log.  Per-topic overrides are a literal map, not a join.

    A file log written by ``publish`` is foldered by ``topic`` and ``date`` (the day of
    ``ts``); pass ``date="date"`` for such a log.  The newest day then comes from the
    folder names alone, the clock is read from that day's folder only (instead of the
    ``ts`` column of the whole log), and a bound on ``date`` (whole days, plus one of
    slack) lets the scan skip expired folders.  The exact bound on ``ts`` decides which
    rows are kept.
    """
    ms: Column = F.lit(retention_ms)
    if overrides and topic:
        m = F.create_map(*[x for k, v in overrides.items() for x in (F.lit(k), F.lit(v))])
        ms = F.coalesce(F.element_at(m, F.col(topic)), F.lit(retention_ms))
    foldered = bool(date) and date in log.columns
    if foldered and as_of is None:
        newest_day = log.agg(F.max(date)).scalar()               # partition column only
        clock = log.filter(F.col(date) == newest_day).agg(F.max(ts)).scalar()
    else:
        clock = _as_of(log, ts, as_of)
        newest_day = F.to_date(clock)
    cutoff = clock - F.make_dt_interval(secs=(ms / F.lit(1000)).cast("decimal(18,6)"))
    keep = (ms < 0) | F.coalesce(F.col(ts) >= cutoff, F.lit(True))
    if foldered:
        days = (F.ceil(ms / F.lit(86_400_000)) + F.lit(1)).cast("int")
        keep = ((ms < 0) | F.col(date).isNull() | (F.col(date) >= F.date_sub(newest_day, days))) & keep
    return log.filter(keep)


def compact_with_lag(log: DataFrame, key: str = "key", order: str = "offset", ts: str = "ts",
                     lag_ms: int = COMPACTION_LAG_MS, value: str = "value",
                     as_of=None, date: str | None = None) -> DataFrame:
    """WIN-7: what a compacted topic still holds — the newest version of each key plus
    every record younger than the compaction lag.  The two parts are disjoint, so
    they are appended without a de-duplicating shuffle.  A record without a timestamp
    counts as old: it stays only as the newest version of its key.

    On a log foldered by ``date`` (``publish``), pass ``date="date"``: the young part then
    reads only the folders from the cutoff's day on (one day of slack for time zones)."""
    live = drop_tombstones(log, value)
    clock = _as_of(live, ts, as_of)
    cutoff = clock - F.make_dt_interval(secs=F.lit(lag_ms / 1000.0).cast("decimal(18,6)"))
    recent = live
    if date and date in live.columns:
        recent = live.filter(F.col(date) >= F.date_sub(F.to_date(cutoff), 1))
    young = recent.filter(F.col(ts) > cutoff)
    newest_old = latest_per_key(live, key, order, value).filter(
        ~F.coalesce(F.col(ts) > cutoff, F.lit(False)))
    return young.unionByName(newest_old.select(*live.columns))


# ------------------------------------------------------------- transitions


def status_transitions(log: DataFrame, key: str = "key", order: str = "offset",
                       status: str = "status") -> DataFrame:
    """WIN-9: audit trail — a key's first version and every version whose status differs
    from the one before (a NULL status is a status of its own).

    Windows run inside ranges of the order, so a key with a huge history is processed
    by many tasks.
    """
    seq = with_previous(log, [key], [order], [status], prefix="prev_", first="_first")
    same = F.col("prev_" + status).eqNullSafe(F.col(status))
    return seq.filter(F.col("_first") | ~same).drop("_first")


# ------------------------------------------------------------------ sets


def union_logs(*logs: DataFrame, topics: Iterable[str] | None = None) -> DataFrame:
    """SET-1: several topics read as one keyed set (columns aligned by name)."""
    out = logs[0]
    for df in logs[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    if topics is not None:
        out = out.filter(F.col("topic").isin(list(topics)))
    return out


def ids_in_all(*dfs: DataFrame, id_col: str = "idea_id") -> DataFrame:
    """SET-2: ids present in every input (distinct)."""
    out = dfs[0].select(id_col)
    for df in dfs[1:]:
        out = out.intersect(df.select(id_col))
    return out


def unique_ids(df: DataFrame, id_col: str = "idea_id") -> DataFrame:
    """AGG-18: distinct ids."""
    return df.select(id_col).distinct()


def stage_counts(records: DataFrame, stage: Column, names: Iterable[str]) -> DataFrame:
    """AGG-15: rows produced per stage, one row per stage (0 for a stage without rows).

    ``stage`` tells each record's stage (NULL: none), so all stages of a log are counted in
    one pass over it."""
    names = list(names)
    counts = records.agg(*[F.count_if(stage == n).alias(n) for n in names])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("stage"), F.col(n).alias("rows")) for n in names])).alias("_s")).select("_s.*")
