"""Per-space state and the decisions made from it.

State rows: ``source, space_key, property, value``; ``space_key`` is null for a
property of the whole source. One row per key; the table grows with the number of
spaces, not with the documents. Joins between such tables carry no hint: Spark
broadcasts a side whose statistics are small and shuffles both otherwise.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

WATERMARK = "watermark"
LAST_START = "last_start"
LAST_FULL = "last_full"
FORCE_FULL = "force_full"
FORCE_INCREMENTAL = "force_incremental"
STOPPED = "stopped"

STATE_COLUMNS = ["source", "space_key", "property", "value"]
STATE_SCHEMA = "source string, space_key string, property string, value timestamp"


def state_key(prop: Column, space_key: Column) -> Column:
    """Storage key: ``_<property>_<space>``, or ``_<property>`` for a source-wide value."""
    return F.concat(F.lit("_"), prop, F.coalesce(F.concat(F.lit("_"), space_key), F.lit("")))


def state_put(state: DataFrame, changes: DataFrame, order: str | None = None) -> DataFrame:
    """State with changed values; a null value deletes. The highest ``order`` wins."""
    rank = F.col(order).cast("bigint") if order else F.lit(0).cast("bigint")
    both = state.select(*STATE_COLUMNS, F.lit(None).cast("bigint").alias("_rank")).unionByName(
        changes.select(*STATE_COLUMNS, rank.alias("_rank"))
    )
    newest = F.max_by(F.struct("value"), F.struct(F.col("_rank").isNotNull(), "_rank"))
    return (
        both.groupBy("source", "space_key", "property").agg(newest.alias("_v"))
        .select("source", "space_key", "property", F.col("_v.value").alias("value"))
        .filter("value is not null")
    )


def state_get(state: DataFrame, prop: str) -> DataFrame:
    return state.filter(F.col("property") == prop).select("source", "space_key", F.col("value").alias(prop))


def state_delete(state: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """State without the keys, and per key whether it existed."""
    held = state.select(F.col("source"), state_key(F.col("property"), F.col("space_key")).alias("_key"), "space_key", "property", "value")
    asked = keys.select("source", state_key(F.col("property"), F.col("space_key")).alias("_key"), "space_key", "property").distinct()
    left = held.join(asked.select("source", "_key"), ["source", "_key"], "left_anti").select(*STATE_COLUMNS)
    found = held.select("source", "_key", F.lit(True).alias("_found"))
    existed = asked.join(found, ["source", "_key"], "left").select(
        "source", "space_key", "property", F.coalesce("_found", F.lit(False)).alias("existed")
    )
    return left, existed


def state_by_space(state: DataFrame) -> DataFrame:
    """One row per space with a column per property."""
    names = [WATERMARK, LAST_START, LAST_FULL, FORCE_FULL, FORCE_INCREMENTAL]
    return state.filter(F.col("space_key").isNotNull()).groupBy("source", "space_key").agg(
        *[F.max(F.when(F.col("property") == name, F.col("value"))).alias(name) for name in names]
    )


def full_due(now: datetime, full_period: timedelta, scheduled: bool) -> Column:
    """Forced, or past the scheduled time, or older than the full period."""
    if scheduled:
        overdue = F.col("next_full_at") < F.lit(now)
    elif full_period < timedelta(milliseconds=1):
        overdue = F.lit(False)
    else:
        overdue = F.col(LAST_FULL).isNull() | (F.col(LAST_FULL) < F.lit(now - full_period))
    return F.col(FORCE_FULL).isNotNull() | F.coalesce(overdue, F.lit(False))


def spaces_due(
    spaces: DataFrame, state: DataFrame, now: datetime, period: timedelta, full_period: timedelta
) -> DataFrame:
    """Spaces to run now, each with ``full`` telling the kind of run."""
    return planned_runs(spaces, state, now, period, full_period).select("source", "space_key", "full")


def planned_runs(
    spaces: DataFrame, state: DataFrame, now: datetime, period: timedelta, full_period: timedelta
) -> DataFrame:
    """Due spaces with ``full`` and the stored ``watermark``.

    A column ``next_full_at`` in ``spaces``, the next time of an external calendar,
    replaces the full period. Stopped sources have no due spaces.
    """
    scheduled = "next_full_at" in spaces.columns
    joined = running_sources(spaces, state).join(state_by_space(state), ["source", "space_key"], "left")
    full = full_due(now, full_period, scheduled)
    due = (
        F.col(FORCE_FULL).isNotNull()
        | F.col(FORCE_INCREMENTAL).isNotNull()
        | F.col(LAST_START).isNull()
    )
    if period > timedelta(0):
        due = due | (F.col(LAST_START) < F.lit(now - period))
    if scheduled or full_period > timedelta(0):
        due = due | full
    return joined.filter(due).select("source", "space_key", full.alias("full"), WATERMARK)


def spaces_due_full(spaces: DataFrame, state: DataFrame, now: datetime, full_period: timedelta) -> DataFrame:
    scheduled = "next_full_at" in spaces.columns
    joined = spaces.join(state_by_space(state), ["source", "space_key"], "left")
    return joined.filter(full_due(now, full_period, scheduled)).select("source", "space_key")


def force(spaces: DataFrame, kind: str, at: datetime, space_key: str | None = None) -> DataFrame:
    """State changes that force a run of one known space, or of all.

    The affected spaces are the rows; an unknown space gives none.
    """
    if kind not in (FORCE_FULL, FORCE_INCREMENTAL):
        raise ValueError(f"unknown kind of run: {kind}")
    known = spaces.select("source", "space_key").distinct()
    if space_key is not None and space_key.strip():
        known = known.filter(F.col("space_key") == space_key)
    return known.select("source", "space_key", F.lit(kind).alias("property"), F.lit(at).alias("value"))


def finish(runs: DataFrame, now: datetime, full_period: timedelta) -> DataFrame:
    """State changes after runs: ``source, space_key, full, ok`` in, state rows out.

    A null value clears the property.
    """
    none = F.lit(None).cast("timestamp")
    at = F.lit(now)
    retry = full_period < timedelta(milliseconds=1)

    def change(prop: str, value: Column) -> Column:
        return F.struct(F.lit(prop).alias("property"), value.alias("value"))

    done = F.when(F.col("full") & F.col("ok"), F.array(change(FORCE_FULL, none), change(LAST_FULL, at)))
    failed = F.when(F.col("full") & ~F.col("ok") & F.lit(retry), F.array(change(FORCE_FULL, at)))
    empty = F.slice(F.array(change("", none)), 1, 0)
    changes = F.concat(F.array(change(FORCE_INCREMENTAL, none)), F.coalesce(done, failed, empty))
    return runs.select("source", "space_key", F.explode(changes).alias("_c")).select(
        "source", "space_key", "_c.property", "_c.value"
    )


def stop_flags(sources: DataFrame, at: datetime | None) -> DataFrame:
    """State changes that stop sources, or with no time let them run again."""
    none = F.lit(None).cast("string")
    return sources.select("source", none.alias("space_key"), F.lit(STOPPED).alias("property"), F.lit(at).cast("timestamp").alias("value"))


def pause(state: DataFrame, sources: DataFrame, at: datetime) -> DataFrame:
    """State with the sources stopped until they are resumed."""
    return state_put(state, stop_flags(sources, at))


def resume(state: DataFrame, sources: DataFrame) -> DataFrame:
    return state_put(state, stop_flags(sources, None))


def running_sources(spaces: DataFrame, state: DataFrame) -> DataFrame:
    stopped = state.filter((F.col("property") == STOPPED) & F.col("space_key").isNull()).select("source").distinct()
    return spaces.join(stopped, ["source"], "left_anti")
