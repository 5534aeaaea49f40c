"""The three-layer run: files or event batches to Bronze, Silver and Gold.

Batch and stream share everything after the read.  Each phase is idempotent for
its batch id; the run stops at the first phase that fails and says which.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from silverlode.catalog import duplicate, mandatory
from silverlode.config import Catalog, Retry, Rule, Source
from silverlode.operators import bronze, merge, quality, scd2
from silverlode.operators.dims import enrich_location
from silverlode.operators.history import transitions
from silverlode.session import materialize
from silverlode.sources.files import read_source
from silverlode.sources.tables import BUCKET, Layer

RUN_LOG, STATISTICS, ALERTS, DEAD_LETTERS, RECONCILIATION, BATCHES = (
    "ingest_run", "dq_run_statistics", "alerts", "dead_letter", "reconciliation_log", "batch",
)
RUN_SCHEMA = """ingest_run_id bigint, batch_id string, pipeline_name string, source_table string, load_error_table string,
    run_status string, source_row_count bigint, valid_row_count bigint, invalid_row_count bigint,
    execution_duration_sec double, error_message string, executed_at timestamp_ntz"""
BATCH_SCHEMA = """batch_id string, pipeline_name string, last_batch_executed_at timestamp_ntz, status string,
    failed_phase string, bronze_insert_records bigint, silver_inserted bigint, silver_updated bigint,
    gold_inserted bigint, gold_updated bigint, batch_log string"""
# The status column whose changes are logged, per entity.
STATUS_COLUMNS = {"order": "order_status", "delivery": "delivery_status"}
EVENT_TS = bronze.EVENT_TS
# What adds an entity's derived columns.
ENRICHERS = {"location": enrich_location}


@dataclass
class RunResult:
    batch_id: str
    source: str
    ingest_run_id: int
    status: str = "SUCCESS"
    failed_phase: str | None = None
    error: str | None = None
    counts: dict[str, int] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)


def side_by_side(*tasks: Callable[[], object]) -> list:
    """Run independent Spark jobs at the same time; a failure is raised after all have ended."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        futures = [pool.submit(task) for task in tasks]
    return [f.result() for f in futures]


def one_row_per_key(source: Source, rules: Sequence[Rule]) -> list[Rule]:
    """``rules``, and those that reject missing and repeated keys where the source's entity has none."""
    key, known = source.keys[0], {(r.kind, r.column) for r in rules}
    added = [mandatory(source.entity, key)]
    if source.merge_on == [key]:
        added.append(duplicate(source.entity, key))
    return [*rules, *[r for r in added if (r.kind, r.column) not in known]]


class PhaseFailed(RuntimeError):
    def __init__(self, result: RunResult):
        super().__init__(f"{result.source}: {result.failed_phase} failed: {result.error}")
        self.result = result


def _moment(now: datetime | None) -> datetime:
    return (now or datetime.now(timezone.utc)).replace(tzinfo=None)


def new_batch_id(kind: str) -> str:
    prefix = {"BATCH": "BATCH", "FILE": "BATCH", "STREAM": "STREAM"}.get(kind.upper(), "GENERIC")
    return f"{prefix}_{uuid.uuid4()}"


class Medallion:
    """Runs configured sources against the tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str, catalog: Catalog, buckets: int = 16):
        self.spark, self.catalog = spark, catalog
        self.layer = Layer(spark, root, buckets)

    # ---- run log -----------------------------------------------------------------------

    def runs(self) -> DataFrame:
        return self.layer.read(RUN_LOG, self._schema(RUN_SCHEMA))

    def _schema(self, ddl: str):
        return self.spark.createDataFrame([], ddl).schema

    def next_run_id(self) -> int:
        """The number after the last logged one.  Runs of several sources at the same time are given theirs by whoever starts them."""
        return self._known_run("")[2] + 1

    def _known_run(self, batch_id: str) -> tuple[bool, int | None, int]:
        """Whether the batch succeeded before, its run id if it was logged, and the last id of all runs."""
        mine = F.col("batch_id") == batch_id
        log = self.runs().agg(
            F.max("ingest_run_id").alias("last"),
            F.max(F.when(mine, F.col("ingest_run_id"))).alias("mine"),
            F.count_if(mine & (F.col("run_status") == "SUCCESS")).alias("done"),
        ).first()
        return log["done"] > 0, log["mine"], log["last"] or 0

    def finished(self, batch_id: str) -> bool:
        return self._known_run(batch_id)[0]

    def _log(self, result: RunResult, source: Source, now: datetime) -> None:
        counts = result.counts
        row = (
            result.ingest_run_id, result.batch_id, source.name, source.target.bronze, source.target.errors, result.status,
            counts.get("source_rows"), counts.get("valid_rows"), counts.get("invalid_rows"),
            float(sum(result.seconds.values())), result.error, now,
        )
        run = self.spark.createDataFrame([row], RUN_SCHEMA)
        log = self.spark.createDataFrame(
            [(result.batch_id, source.name, now, result.status, result.failed_phase, counts.get("source_rows"),
              counts.get("silver_inserted"), counts.get("silver_updated"), counts.get("gold_inserted"),
              counts.get("gold_updated"), None)], BATCH_SCHEMA,
        )
        nested = F.to_json(
            F.struct(
                "batch_id", "pipeline_name", "status",
                F.struct("bronze_insert_records").alias("stage_to_bronze"),
                F.struct("silver_inserted", "silver_updated").alias("bronze_to_silver"),
                F.struct("gold_inserted", "gold_updated").alias("silver_to_gold"),
            )
        )
        log = log.withColumn("batch_log", nested)
        side_by_side(lambda: self.layer.append(log, BATCHES), lambda: self.layer.append(run, RUN_LOG))

    # ---- entry points ------------------------------------------------------------------

    def run_files(
        self, source_name: str, root: str, file: str | None = None, *, now: datetime | None = None,
        batch_id: str | None = None, strict: bool = False, run_id: int | None = None,
    ) -> RunResult:
        source = self.catalog.source(source_name)
        return self.run_rows(
            source, lambda: read_source(self.spark, source, root, file, strict), now=now,
            batch_id=batch_id or new_batch_id(source.ingestion), strict=strict, run_id=run_id,
        )

    def run_rows(
        self, source: Source, read: Callable[[], DataFrame], *, batch_id: str, now: datetime | None = None,
        strict: bool = False, run_id: int | None = None,
    ) -> RunResult:
        """All three phases over text rows.  A batch id that already succeeded is not run again.

        Rows of a stream source carry ``event_ts``: the latest valid event of a key
        wins, and never replaces a newer stored one.
        """
        moment = _moment(now)
        done, known, last = self._known_run(batch_id)
        if done:
            return RunResult(batch_id, source.name, known, status="SKIPPED")
        result = RunResult(batch_id, source.name, known or run_id or last + 1)
        at = F.lit(moment).cast("timestamp_ntz")
        phases = (
            ("STAGE_TO_BRONZE", lambda: self._to_bronze(source, read(), result, at, strict)),
            ("BRONZE_TO_SILVER", lambda: self._to_silver(source, result, at)),
            ("SILVER_TO_GOLD", lambda: self._to_gold(source, result, at)),
        )
        for name, phase in phases:
            started = time.monotonic()
            try:
                phase()
            except Exception as error:
                result.seconds[name] = time.monotonic() - started
                result.status, result.failed_phase, result.error = "FAILED", name, str(error)
                self._log(result, source, moment)
                raise PhaseFailed(result) from error
            result.seconds[name] = time.monotonic() - started
        self._log(result, source, moment)
        for table in (source.target.silver, source.target.gold, self._history(source)):
            self.layer.forget(table, batch_id)
        return result

    # ---- phases ------------------------------------------------------------------------

    def _to_bronze(self, source: Source, rows: DataFrame, result: RunResult, now: Column, strict: bool) -> None:
        seen = Observation()
        typed = bronze.audit(bronze.project(rows, source, strict), result.ingest_run_id, now)
        typed = typed.observe(seen, F.count(F.lit(1)).alias("rows"))
        self.layer.replace_partitions(typed, source.target.bronze, ["ingest_run_id"])
        result.counts["source_rows"] = seen.get["rows"]

    def _to_silver(self, source: Source, result: RunResult, now: Column) -> None:
        target, key = source.target, source.keys[0]
        rules = one_row_per_key(source, self.catalog.rules_for(source.entity))
        if result.counts.get("source_rows") == 0:
            return
        streaming = source.ingestion == "STREAM"
        if streaming:
            rules = [r for r in rules if r.kind != "DUPLICATE_ALLOW_ONE_CHECK"]
        self._finish_silver(source)
        if self.layer.is_published(target.silver, result.batch_id):
            # an earlier attempt came this far, or was carried on by the batch after it
            figures = self.layer.read(STATISTICS).where((F.col("ingest_run_id") == result.ingest_run_id) & (F.col("entity") == source.entity)).first()
            result.counts["valid_rows"], result.counts["invalid_rows"] = figures["total_valid_rows"], figures["total_invalid_rows"]
            counts = self._silver_figures(result)
            result.counts.update(self.layer.staged(target.silver, result.batch_id).agg(*[c.alias(n) for n, c in counts.items()]).first().asDict())
            return
        staged = bronze.stage(self.layer.read(target.bronze), result.ingest_run_id).select(*source.names, EVENT_TS)
        references = _References(self.layer)
        checked = f"{target.bronze}_checked"
        try:
            # Written, not cached: what the checks have shuffled is gone before the next steps shuffle.
            validated = self.layer.stage(quality.validate(staged, rules, key, references), checked, result.batch_id)[0]
            figures = quality.statistics(validated, rules, result.ingest_run_id)
            row = figures.first()
            result.counts["valid_rows"], result.counts["invalid_rows"] = row["total_valid_rows"], row["total_invalid_rows"]
            stats = self.spark.createDataFrame([row], figures.schema).withColumn("entity", F.lit(source.entity))
            errors = quality.error_rows(validated, key, result.ingest_run_id)
            good = quality.valid_rows(validated).select(*source.names, EVENT_TS)
            # All of these read Silver as it was; it is published after they have ended.  The two that move all rows
            # run one after the other, so that what the first has shuffled is gone when the second shuffles.
            self._stage_transitions(source, good, result, now)
            size = self.layer.size(self.layer.path(target.silver)) + self.layer.staged_size(checked, result.batch_id)
            side_by_side(
                lambda: self._stage_silver(source, good, size, result, now),
                lambda: self.layer.replace_partitions(errors, target.errors, ["ingest_run_id"]),
                lambda: self.layer.replace_partitions(stats, STATISTICS, ["entity", "ingest_run_id"]),
            )
            self.layer.mark_ready(target.silver, result.batch_id)
            self._finish_silver(source)
        finally:
            self.layer.forget(checked, result.batch_id)

    def _finish_silver(self, source: Source) -> None:
        """Publish what is ready, of whichever batch: its rows and, where statuses are logged, its transitions."""
        layer, silver = self.layer, source.target.silver
        for batch_id in layer.unpublished(silver):
            changes = layer.staged(self._history(source), batch_id) if source.entity in STATUS_COLUMNS else None
            self._publish_silver(source, batch_id, changes)
            layer.mark_published(silver, batch_id)

    @staticmethod
    def _silver_figures(result: RunResult) -> dict[str, Column]:
        mine, first = F.col("batch_id") == result.batch_id, F.col("created_at") == F.col("updated_at")
        return {"silver_inserted": F.count_if(mine & first), "silver_updated": F.count_if(mine & ~first)}

    def _stage_silver(self, source: Source, good: DataFrame, size: int, result: RunResult, now: Column) -> None:
        target, keys, layer = source.target, source.merge_on, self.layer
        newest_by = None
        if source.ingestion == "STREAM":
            newest_by = EVENT_TS
            good = merge.latest_per_key(good, source.keys, [EVENT_TS, *source.names])
        good = ENRICHERS.get(source.entity, lambda rows: rows)(good)
        batch = merge.stamp(good, result.batch_id, now).withColumn(BUCKET, layer.bucket_of(keys))
        stored = layer.read(target.silver, batch.schema)

        def after(buckets: list[int]) -> DataFrame:
            old, new = (rows.where(F.col(BUCKET).isin(buckets)) for rows in (stored, batch))
            if target.load_type == "APPEND":
                return old.unionByName(merge.append_absent(old, new, keys))
            return merge.upsert_whole(old, new, keys, newest_by=newest_by)

        groups = layer.groups(layer.touched(batch, keys), size)
        result.counts.update(layer.stage_groups(after, groups, target.silver, result.batch_id, self._silver_figures(result)))

    def _stage_transitions(self, source: Source, good: DataFrame, result: RunResult, now: Column) -> None:
        """Every status change of the batch, also those that only the latest row per key survives."""
        if source.entity not in STATUS_COLUMNS:
            return
        status, key, silver = STATUS_COLUMNS[source.entity], source.keys[0], source.target.silver
        timed = good.withColumn(EVENT_TS, F.coalesce(F.col(EVENT_TS), now))
        timed, last = timed.select(key, status, EVENT_TS), None
        if self.layer.exists(silver):
            # Events older than the stored state never became current, so they are no transition.
            # Only the batch's buckets are read, and only its keys leave the scan.
            near = self.layer.read(silver).where(F.col(BUCKET).isin(self.layer.touched(good, source.merge_on)))
            stored = merge.stored_for(near, good, [key], [status, EVENT_TS]).withColumnsRenamed({status: "_stored", EVENT_TS: "_stored_ts"})
            timed, last = timed.join(stored, key, "left").where(
                F.col("_stored_ts").isNull() | (F.col(EVENT_TS) >= F.col("_stored_ts"))
            ), "_stored"
        changes = transitions(timed, key, status, EVENT_TS, [status], last).withColumn("batch_id", F.lit(result.batch_id))
        self.layer.stage(changes, self._history(source), result.batch_id)

    def _history(self, source: Source) -> str:
        return f"{source.target.gold}_status_history"

    def _publish_silver(self, source: Source, batch_id: str, changes: DataFrame | None) -> None:
        layer, silver = self.layer, source.target.silver

        def rows() -> None:
            staged = layer.staged(silver, batch_id)
            for buckets in layer.staged_groups(silver, batch_id):
                layer.replace_partitions(staged.where(F.col(BUCKET).isin(buckets)), silver, [BUCKET])

        publish = [rows]
        if changes is not None:
            publish.append(lambda: layer.replace_partitions(changes, self._history(source), ["batch_id"]))
        side_by_side(*publish)

    def _to_gold(self, source: Source, result: RunResult, now: Column) -> None:
        """Version the rows this batch put into Silver.

        Open versions live in ``<gold>/status=ACTIVE`` by key bucket; expired ones are
        only ever added, in one partition of their batch, so history is not rewritten.
        """
        layer, gold, keys = self.layer, source.target.gold, source.keys
        if result.counts.get("source_rows") == 0:
            return
        self._finish_gold(gold)
        new, gone = F.count_if((F.col("batch_id") == result.batch_id) & (F.col("status") == "ACTIVE")), F.count_if(F.col("status") == "INACTIVE")
        figures = {"new": new, "expired": gone}
        if layer.is_published(gold, result.batch_id):
            counts = layer.staged(gold, result.batch_id).agg(*[c.alias(n) for n, c in figures.items()]).first()
            result.counts["gold_inserted"], result.counts["gold_updated"] = counts["new"] - counts["expired"], counts["expired"]
            return
        batch = layer.staged(source.target.silver, result.batch_id).where(F.col("batch_id") == result.batch_id)
        batch = batch.select(*source.silver_names).withColumn(BUCKET, layer.bucket_of(keys))
        shape = scd2.new_versions(
            batch.withColumn("row_hash", F.lit("")).withColumn("scd_action", F.lit("INSERT")), batch_id=result.batch_id, now=now
        ).withColumn("expired_by", F.lit(""))
        active = layer.read(gold, shape.schema).where(F.col("status") == "ACTIVE").drop("expired_by")

        def after(buckets: list[int]) -> DataFrame:
            old, new = (rows.where(F.col(BUCKET).isin(buckets)) for rows in (active, batch))
            rows = scd2.versions_after(old, new, keys, source.silver_names, batch_id=result.batch_id, now=now)
            expired = F.col("status") == "INACTIVE"
            return rows.withColumn("expired_by", F.when(expired, F.lit(result.batch_id)).otherwise("open"))

        size = layer.size(f"{layer.path(gold)}/status=ACTIVE") + layer.staged_size(source.target.silver, result.batch_id)
        groups = layer.groups(layer.touched(batch, keys), size)
        counts = layer.stage_groups(after, groups, gold, result.batch_id, figures)
        layer.mark_ready(gold, result.batch_id)
        self._finish_gold(gold)
        result.counts["gold_inserted"] = counts["new"] - counts["expired"]
        result.counts["gold_updated"] = counts["expired"]

    def _finish_gold(self, gold: str) -> None:
        """Publish what is ready, of whichever batch.  Expired rows need no bucket: they are never looked up by key.

        Hashes are worked out here, as they would be most of what is moved and staged; tracked columns stand before them.
        """
        for batch_id in self.layer.unpublished(gold):
            staged = self.layer.staged(gold, batch_id)
            tracked = [c for c in staged.columns[: staged.columns.index("row_hash")] if c != BUCKET]
            groups, expired = self.layer.staged_groups(gold, batch_id), F.col("status") == "INACTIVE"
            # all that a batch expires is one partition; open versions follow by groups of buckets
            parts = [~expired & F.col(BUCKET).isin(buckets) for buckets in groups]
            for part in [F.lit(True)] if len(groups) == 1 else [expired, *parts]:
                rows = scd2.unpack_hash(staged.where(part), tracked).withColumn(BUCKET, F.when(expired, -1).otherwise(F.col(BUCKET)))
                self.layer.replace_partitions(rows, gold, ["status", "expired_by", BUCKET])
            self.layer.mark_published(gold, batch_id)

    # ---- recovery ----------------------------------------------------------------------

    def reconcile(self, source_name: str, batch_id: str, run_id: int, now: datetime | None = None, known: Mapping[str, int] | None = None) -> DataFrame:
        """Compare the layers' counts for one batch and log both steps; a run's own figures (``known``) save reading the layers."""
        target, layer = self.catalog.source(source_name).target, self.layer
        if known is not None:
            figures = [known.get("source_rows", 0), *[known.get(f"{x}_inserted", 0) + known.get(f"{x}_updated", 0) for x in ("silver", "gold")]]
            counts = self.spark.createDataFrame([figures], "bronze bigint, silver bigint, gold bigint")
            return self._log_reconciled(counts, source_name, batch_id, now)
        counts = layer.read(target.bronze).where(F.col("ingest_run_id") == run_id).agg(F.count(F.lit(1)).alias("bronze"))
        for name, table in (("silver", target.silver), ("gold", target.gold)):
            rows = layer.read(table).where(F.col("batch_id") == batch_id)
            counts = counts.withColumn(name, rows.agg(F.count(F.lit(1))).scalar())
        return self._log_reconciled(counts, source_name, batch_id, now)

    def _log_reconciled(self, counts: DataFrame, source_name: str, batch_id: str, now: datetime | None) -> DataFrame:
        from silverlode.plans.operations import reconcile_counts

        counts = counts.select(F.lit(source_name).alias("pipeline_name"), F.lit(batch_id).alias("batch_id"), "*")
        logged = reconcile_counts(counts).withColumn("reconciled_at", F.lit(_moment(now)).cast("timestamp_ntz"))
        self.layer.append(logged, RECONCILIATION)
        return logged

    def run_with_recovery(self, source_name: str, root: str, file: str | None = None, **options) -> RunResult:
        """Run and reconcile; a failure becomes a dead letter and a critical alert."""
        try:
            result = self.run_files(source_name, root, file, **options)
        except PhaseFailed as failure:
            result, now = failure.result, _moment(options.get("now"))
            self._bury(self.catalog.source(source_name), root, file, result, now)
            alert = self.spark.createDataFrame(
                [(source_name, "FAILURE", "CRITICAL", f"Pipeline execution failed: {result.error}", "OPEN", now)],
                "pipeline_name string, alert_type string, severity string, alert_message string, alert_status string, detected_at timestamp_ntz",
            )
            self.layer.append(alert, ALERTS)
            return result
        if result.status == "SUCCESS":
            self.reconcile(source_name, result.batch_id, result.ingest_run_id, options.get("now"), result.counts)
        return result

    def _bury(self, source: Source, root: str, file: str | None, result: RunResult, now: datetime) -> None:
        """A letter for each record of the failed batch, or one that names the files where they can't be read."""
        path = F.lit(file or root).alias("stage_path")
        try:
            rows = read_source(self.spark, source, root, file)
            records = rows.select(F.to_json(F.struct(*source.names, path)).alias("record_data"))
            self._write_letters(records, source, result, now)
        except Exception:  # noqa: BLE001 - whatever keeps the files from being read is what the letter is about
            records = self.spark.range(1).select(F.to_json(F.struct(path)).alias("record_data"))
            self._write_letters(records, source, result, now)

    def _write_letters(self, records: DataFrame, source: Source, result: RunResult, now: datetime) -> None:
        at = F.lit(now).cast("timestamp_ntz")
        letters = records.select(
            F.concat(F.lit(f"{result.batch_id}-"), F.monotonically_increasing_id().cast("string")).alias("dlq_id"),
            F.lit(source.name).alias("pipeline_name"), F.lit("TECHNICAL").alias("error_type"),
            F.lit(result.error).alias("error_message"), F.lit(result.ingest_run_id).cast("long").alias("ingest_run_id"),
            F.lit(0).alias("retry_count"), F.lit("PENDING").alias("processing_status"), at.alias("created_at"),
            F.lit(None).cast("timestamp_ntz").alias("last_retry_at"), "record_data", F.lit(result.batch_id).alias("batch_id"),
        )
        self.layer.replace_partitions(letters, DEAD_LETTERS, ["batch_id"])

    def retry_dead_letters(self, source_name: str, retries: Sequence[Retry], table: str = DEAD_LETTERS, **options) -> RunResult:
        """Run this engine's own due letters of a source again and store how they were settled; ``table`` may be a stream's."""
        letters = self.layer.read(table)
        mine = letters.where(F.col("pipeline_name") == source_name)
        result, queue = self.retry_letters(source_name, mine, retries, **options)
        # written first, as the table it comes from is replaced
        self.layer.replace_partitions(materialize(queue, "settled"), table, ["batch_id"])
        return result

    def retry_letters(
        self, source_name: str, letters: DataFrame, retries: Sequence[Retry], *, now: datetime | None = None,
        limit: int | None = None, batch_id: str | None = None,
    ) -> tuple[RunResult, DataFrame]:
        """Run the payloads of due letters again, all at once; returns the run and the settled queue.

        A letter succeeds when its key reached Silver in this run.
        """
        from silverlode.plans.operations import retry_candidates, settle_retries

        source, moment = self.catalog.source(source_name), _moment(now)
        mine = letters.where(F.col("pipeline_name") == source_name)
        due = materialize(retry_candidates(mine, retries, moment, limit), "retry")
        payload = [F.get_json_object("record_data", f"$.{n}").alias(n) for n in source.names]
        result = self.run_rows(
            source, lambda: due.select(*payload), batch_id=batch_id or new_batch_id(source.ingestion), now=moment
        )
        key = source.keys[0]
        silver = self.layer.read(source.target.silver) if self.layer.exists(source.target.silver) else None
        keyed = due.select("dlq_id", F.get_json_object("record_data", f"$.{key}").alias("_key"))
        if silver is None:
            outcome = keyed.select("dlq_id", F.lit(False).alias("succeeded"))
        else:
            arrived = silver.where(F.col("batch_id") == result.batch_id).select(F.col(key).cast("string").alias("_key"), F.lit(True).alias("succeeded"))
            outcome = keyed.join(arrived, "_key", "left").drop("_key")
        return result, settle_retries(letters, due, outcome, moment)

    def summary(self, result: RunResult) -> Mapping:
        return asdict(result)


class _References(Mapping):
    """Layer tables by name, for lookup rules; read when a rule asks."""

    def __init__(self, layer: Layer):
        self.layer = layer

    def __getitem__(self, name: str) -> DataFrame:
        return self.layer.read(name)

    def __contains__(self, name: object) -> bool:
        return isinstance(name, str) and self.layer.exists(name)

    def __iter__(self):
        return iter(())

    def __len__(self) -> int:
        return 0
