"""The target of a synchronisation as append-only Parquet tables.

``rows``      every version of every row, partitioned by source, space, run and kind
``runs``      the finished runs; a run counts once its row is here. Runs of streams name
              the stream and its batch
``state``     changes of watermarks and flags, one generation per run; every so many
              generations a snapshot in ``snapshots`` takes their place
``messages``  what each run said of documents it did not store, with counts
``plans``     the spaces each run set out to read
``reports``   the counters of each run
``activity``  run records

A run only adds files, so its cost follows the changes and not the target, readers
are never disturbed, and a run that dies leaves files that no finished run names. A
full run restarts a space: older runs of the space are not read any more, which is
what removes the rows it did not refresh.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from syncspark.operators.changes import DELETE_SCOPE, ROW_KEY
from syncspark.operators.joins import keyed_join
from syncspark.operators.state import STATE_SCHEMA

ROWS_SCHEMA = (
    "doc_type string, doc_id string, parent_id string, document_id string, body string, "
    "updated timestamp, indexed_at timestamp, page_no bigint, pos bigint, "
    "at_run bigint, source string, space_key string, run_id bigint, op string"
)
ROWS_PARTITIONS = ["source", "space_key", "run_id", "op"]
RUNS_SCHEMA = (
    "source string, space_key string, run_id bigint, full boolean, stream string, batch_id bigint, "
    "level int, folds array<bigint>, first bigint, last bigint, restart bigint"
)
FAN = 8  # runs of a level that are folded into one
SNAPSHOT = 32  # generations of state between snapshots


class SyncStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str, schema: str) -> DataFrame:
        """A table as it is now; not yet written is empty."""
        try:
            return self.spark.read.schema(schema).parquet(self.path(table))
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], schema)

    def rows(self) -> DataFrame:
        return self.read("rows", ROWS_SCHEMA)

    def runs(self) -> DataFrame:
        return self.read("runs", RUNS_SCHEMA)

    def next_run(self) -> int:
        """Number of a new run, above all finished ones: passes and streams share one order."""
        last = self.runs().agg(F.max(F.greatest("run_id", "last"))).first()[0] or 0
        return max(time.time_ns() // 1000, last + 1)

    def commit(self, runs: DataFrame, run_id: int, stream: str | None = None, batch_id: int | None = None) -> None:
        """Make the rows of a run visible for the spaces in ``runs`` (source, space_key, full)."""
        runs.select(
            "source", "space_key", F.lit(run_id).cast("bigint").alias("run_id"), "full",
            F.lit(stream).cast("string").alias("stream"), F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.lit(0).alias("level"), F.lit(None).cast("array<bigint>").alias("folds"), F.lit(run_id).cast("bigint").alias("first"),
            F.lit(run_id).cast("bigint").alias("last"), F.when(F.col("full"), F.lit(run_id)).cast("bigint").alias("restart"),
        ).write.mode("append").parquet(self.path("runs"))

    def has_batch(self, stream: str, batch_id: int) -> bool:
        """Whether a batch of a stream was committed; it is then not stored again."""
        return not self.runs().filter((F.col("stream") == stream) & (F.col("batch_id") == batch_id)).isEmpty()

    def activity(self) -> DataFrame:
        from syncspark.operators.activity import RECORD_SCHEMA

        return self.read("activity", RECORD_SCHEMA)

    def state(self, source: str) -> DataFrame:
        """State of a source: its newest snapshot and the changes since."""
        folded, since = self._folded(source)
        return folded.filter("value is not null")

    def _folded(self, source: str) -> tuple[DataFrame, int]:
        """The newest value per key, deleted ones as null, and how many generations lie behind the snapshot."""
        schema = STATE_SCHEMA + ", generation bigint"
        kept = self.read("snapshots", schema).filter(F.col("source") == source)
        at = kept.agg(F.max("generation")).first()[0] or 0
        since = self.read("state", schema).filter((F.col("source") == source) & (F.col("generation") > at))
        both = kept.filter(F.col("generation") == at).unionByName(since)
        newest = F.max_by(F.struct("value"), F.col("generation"))
        folded = both.groupBy("source", "space_key", "property").agg(newest["value"].alias("value"))
        return folded, since.select("generation").distinct().count()

    def write_state(self, changes: DataFrame, source: str, generation: int) -> None:
        """Append changed values as a generation; a null value deletes. What it costs follows the
        changes, but for a snapshot now and then."""
        changes.filter(F.col("source") == source).select("source", "space_key", "property", "value").withColumn(
            "generation", F.lit(generation).cast("bigint")
        ).write.mode("append").partitionBy("generation").parquet(self.path("state"))
        folded, since = self._folded(source)
        if since >= SNAPSHOT:
            folded.filter("value is not null").withColumn("generation", F.lit(generation).cast("bigint")).write.mode("append").partitionBy(
                "generation"
            ).parquet(self.path("snapshots"))

    def save(self, df: DataFrame, table: str, run_id: int) -> DataFrame:
        """Keep a small intermediate result as a table: later steps read it instead of
        computing it again, and a lost executor costs nothing."""
        path = f"{self.path(table)}/run_id={run_id}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def live_runs(self, runs: DataFrame | None = None) -> DataFrame:
        """Runs that make up the target: from the last full run of each space on, without
        those that are folded into others."""
        live = self._live(self.runs() if runs is None else runs).select("source", "space_key", "run_id").distinct()
        # True of every run, but only a side with a filter is used to prune partitions.
        return live.filter("run_id >= 0")

    def _live(self, runs: DataFrame) -> DataFrame:
        keys = ["source", "space_key"]
        known = runs.withColumns({
            "level": F.coalesce("level", F.lit(0)), "first": F.coalesce("first", "run_id"), "last": F.coalesce("last", "run_id"),
            "restart": F.coalesce("restart", F.when(F.col("full"), F.col("run_id"))),
        })
        base = known.groupBy(*keys).agg(F.max("restart").alias("_base"))
        folded = runs.select(*keys, F.explode("folds").alias("run_id")).distinct()
        return known.join(base, keys).filter(F.col("last") >= F.coalesce("_base", F.lit(0))).drop("_base").join(folded, [*keys, "run_id"], "left_anti")

    def compact(self, fan: int = FAN, before: int | None = None) -> int:
        """Fold each ``fan`` or more live runs of a space and level into one of the next level;
        returns how many runs were folded.

        Of a key the newest version stays, of a document the newest delete; deletes go when
        nothing older is left that they could hit. Only runs up to ``before`` are folded, those
        that no unfinished run may still come in front of. Readers see the same rows before and
        after: folded rows keep the order of their runs, and count once the new run is committed.
        """
        keys = ["source", "space_key"]
        live = self._live(self.runs())
        if before is not None:
            live = live.filter(F.col("last") <= before)
        groups = live.groupBy(*keys, "level").agg(
            F.count("*").alias("n"), F.collect_list("run_id").alias("folds"), F.min("first").alias("first"), F.max("last").alias("last"), F.max("restart").alias("restart")
        ).filter(F.col("n") >= fan)
        # The oldest of a space has nothing before it.
        oldest = live.groupBy(*keys).agg(F.min("first").alias("_first"))
        run_id = self.next_run()
        plan = self.save(groups.join(oldest, keys).withColumn("bottom", F.col("first") <= F.col("_first")).drop("_first"), "folded", run_id)
        total = plan.agg(F.sum("n")).first()[0] or 0
        if not total:
            return 0
        chosen = plan.select(*keys, "level", "bottom", F.explode("folds").alias("run_id"))
        rows = keyed_join(self.rows(), chosen.select(*keys, "run_id", "level", "bottom"), [*keys, "run_id"], "inner", hot=True)
        rows = rows.withColumn("at_run", F.coalesce("at_run", "run_id"))
        order = F.struct("at_run", "page_no", "pos")
        data = [c for c in self.rows().columns if c not in (*ROW_KEY, "source", "space_key", "run_id", "op")]
        newest = (
            rows.filter("op = 'upsert'").groupBy(*dict.fromkeys([*keys, "level", *ROW_KEY])).agg(F.max_by(F.struct(*data), order).alias("_v"))
            .select(*dict.fromkeys([*keys, "level", *ROW_KEY]), "_v.*").withColumn("op", F.lit("upsert"))
        )
        scope = list(dict.fromkeys([*keys, "level", *DELETE_SCOPE]))
        drops = (
            rows.filter("op = 'delete'").groupBy(*scope, "bottom").agg(F.max_by(F.struct(*[c for c in [*data, *ROW_KEY] if c not in scope]), order).alias("_v"), F.max(order).alias("_gone"))
        )
        met = keyed_join(newest, drops.select(*scope, "_gone", "bottom"), scope, "left")
        met = met.withColumn("_hit", F.coalesce(F.struct("at_run", "page_no", "pos") <= F.col("_gone"), F.lit(False)))
        # A deleted row that came from another space still hides its older version there.
        gone = self.save(met.filter("_hit and bottom").select(*ROW_KEY, *[F.col(k).alias(f"_{k}") for k in keys]), "gone", run_id)
        elsewhere = self.rows().filter("op = 'upsert'").select(*ROW_KEY, *keys).join(gone, ROW_KEY)
        elsewhere = elsewhere.filter((F.col("source") != F.col("_source")) | (F.col("space_key") != F.col("_space_key")))
        hides = elsewhere.select(*ROW_KEY, F.col("_source").alias("source"), F.col("_space_key").alias("space_key")).distinct().withColumn("_hides", F.lit(True))
        met = met.join(hides, [*ROW_KEY, *keys], "left").withColumn("_stays", F.col("_hit") & (~F.col("bottom") | F.coalesce("_hides", F.lit(False))))
        alive = met.filter("not _hit or _stays").withColumn("body", F.when(~F.col("_hit"), F.col("body"))).drop("_gone", "_hit", "_hides", "_stays", "bottom")
        needed = met.filter("_stays").select(*scope).distinct().withColumn("_needed", F.lit(True))
        kept = drops.join(needed, scope, "left").filter("not bottom or _needed").select(*scope, "_v.*").withColumn("op", F.lit("delete"))
        out = alive.unionByName(kept, allowMissingColumns=True).withColumn("run_id", F.lit(run_id).cast("bigint") + F.col("level")).drop("level")
        out.select(*self.rows().columns).hint("rebalance", *keys).write.mode("append").partitionBy(*ROWS_PARTITIONS).parquet(self.path("rows"))
        plan.select(
            *keys, (F.lit(run_id).cast("bigint") + F.col("level")).alias("run_id"), F.col("restart").isNotNull().alias("full"), F.lit(None).cast("string").alias("stream"),
            F.lit(None).cast("bigint").alias("batch_id"), (F.col("level") + 1).alias("level"), "folds", "first", "last", "restart",
        ).write.mode("append").parquet(self.path("runs"))
        return total

    def dead_runs(self) -> DataFrame:
        """Runs (source, space_key, run_id) whose files no reader needs any more."""
        return self.runs().select("source", "space_key", "run_id").distinct().join(self.live_runs(), ["source", "space_key", "run_id"], "left_anti")

    def current(
        self, columns: list[str] = ("parent_id", "body", "indexed_at"), runs: DataFrame | None = None, only: DataFrame | None = None,
    ) -> DataFrame:
        """Rows of the target: the newest version of each key that no later delete hits.

        ``columns`` names what is wanted beyond key and scope; the rest is not read.
        ``only`` some documents (source, space_key, document_id) are looked at, if given.
        """
        live = keyed_join(self.rows(), self.live_runs(runs), ["source", "space_key", "run_id"], "left_semi", hot=True)
        if only is not None:
            live = keyed_join(live, only, DELETE_SCOPE, "left_semi")
        held = [c for c in DELETE_SCOPE if c not in ROW_KEY] + list(columns)
        order = F.struct(F.coalesce("at_run", "run_id").alias("run_id"), "page_no", "pos")
        newest = (
            live.filter("op = 'upsert'").groupBy(*ROW_KEY)
            .agg(F.max_by(F.struct(*held), order).alias("_v"), F.max(order).alias("_at"))
            .select(*ROW_KEY, "_v.*", "_at")
        )
        gone = live.filter("op = 'delete'").groupBy(*DELETE_SCOPE).agg(F.max(order).alias("_gone"))
        return (
            keyed_join(newest, gone, DELETE_SCOPE, "left")
            .filter(F.col("_gone").isNull() | (F.col("_at") > F.col("_gone")))
            .select(*ROW_KEY, *held)
        )
