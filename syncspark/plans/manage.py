"""Operations on a stored synchronisation: force runs, pause, resume, report."""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from syncspark.operators import activity as act, state as st
from syncspark.plans.store import SyncStore


def _sources(store: SyncStore, source: str) -> DataFrame:
    return store.spark.range(1).select(F.lit(source).alias("source"))


def force_run(
    store: SyncStore, source: str, spaces: DataFrame, kind: str, at: datetime, space_key: str | None = None
) -> DataFrame:
    """Make spaces due; the affected ones are returned, none when the space is unknown."""
    changes = st.force(spaces.filter(F.col("source") == source), kind, at, space_key)
    changes = store.save(changes, "forced", generation := time.time_ns() // 1000)
    store.write_state(changes, source, generation)
    return changes.select("source", "space_key")


def pause_source(store: SyncStore, source: str, at: datetime) -> None:
    store.write_state(st.stop_flags(_sources(store, source), at), source, time.time_ns() // 1000)


def resume_source(store: SyncStore, source: str) -> None:
    store.write_state(st.stop_flags(_sources(store, source), None), source, time.time_ns() // 1000)


def source_report(store: SyncStore, source: str, spaces: DataFrame, now: datetime, since: datetime) -> DataFrame:
    """State report of a source out of its store; ``since`` is when it last started."""
    stopped = store.state(source).filter(F.col("property") == st.STOPPED).agg(F.max("value")).first()[0]
    head = _sources(store, source).select(
        "source",
        F.lit(now).alias("info_date"),
        F.lit("running" if stopped is None else "stopped").alias("state"),
        F.lit(since if stopped is None else stopped).alias("since"),
    )
    records = act.run_rows(store.activity().filter(F.col("source") == source))
    return act.state_report(head, records.limit(0), spaces.filter(F.col("source") == source), records)
