"""Generic flow for one table: new bronze rows to silver and quarantine."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs import schemas
from lakejobs.operators import filters, gold, governance, projections, quality, tables
from lakejobs.operators.dedup import dedup
from lakejobs.operators.ledger import (
    DONE, PUBLISHED, STAGED, Entry, Ledger, LoadFinished, Standing, schema_of,
)
from lakejobs.paths import LakePaths
from lakejobs.plans.together import together
from lakejobs.session import path_exists

# The partition column of silver and quarantine.
BATCH = "batch_id"


@dataclass
class Result:
    """What a run did."""

    batch_id: str
    written: int = 0
    quarantined: int = 0
    issues: list[str] = field(default_factory=list)


class EventLog:
    """Events of one run, appended to the event table in one write."""

    def __init__(self, batch_id: str, table: str):
        self.batch_id, self.table, self.rows = batch_id, table, []

    def add(self, kind: str, message: str, **details: object) -> None:
        self.rows.append({
            "timestamp": datetime.now(timezone.utc), "batch_id": self.batch_id,
            "table_name": self.table, "event_type": kind, "message": message,
            "details": {k: str(v) for k, v in details.items()},
        })

    def save(self, spark: SparkSession, lake: LakePaths) -> None:
        if self.rows:
            frame = tables.few_rows(spark, self.rows, schemas.PROCESSING_EVENTS)
            frame.write.mode("append").parquet(lake.monitoring("processing_events"))
            self.rows = []


def standardize(df: DataFrame, batch_id: str) -> DataFrame:
    """Normal names, audit columns and clean text."""
    named = projections.process_audit(projections.normalize_names(df), batch_id=batch_id)
    return projections.clean_strings(named)


def ledger_of(spark: SparkSession, lake: LakePaths, table: str) -> Ledger:
    return Ledger(spark, f"{lake.monitoring('load_ledger')}/{table}")


def run(
    bronze: DataFrame,
    lake: LakePaths,
    table: str,
    batch_id: str,
    checks: quality.Checks = quality.Checks(),
    mode: str = "incremental",
    ts_col: str = "ingestion_timestamp",
    late: filters.Late | None = None,
) -> Result:
    """Load one table; ``checks`` are made on the valid rows.

    ``incremental`` takes rows whose ingestion time is later than the last one loaded
    before and adds them; a row with just that time is not new.  With ``late`` it also takes
    rows that arrive behind that time and were not loaded yet.  ``full`` replaces the table.
    At level ``critical`` failed checks stop the load before anything is published.

    The ledger tells how far a batch got.  A batch that died is taken up where it stopped, with
    the input it had staged, whatever has arrived since; other unfinished batches of the
    table are finished first.  A batch that is done is refused with ``LoadFinished``.
    """
    spark = bronze.sparkSession
    ledger = ledger_of(spark, lake, table)
    standing = ledger.standing(batch_id)
    if standing.own is not None and standing.own.state == DONE:
        raise LoadFinished(f"batch {batch_id} of {table} is done")
    others = [e for e in standing.open if e.batch_id != batch_id]
    for entry in others:
        finish(bronze, lake, table, entry, standing, EventLog(entry.batch_id, table))
    if others:
        standing = ledger.standing(batch_id)
    log, entry = EventLog(batch_id, table), standing.own
    if entry is None:
        entry = stage(bronze, lake, table, batch_id, standing, checks, mode, ts_col, late, log)
    return finish(bronze, lake, table, entry, standing, log)


def stage(
    bronze: DataFrame, lake: LakePaths, table: str, batch_id: str, standing: Standing,
    checks: quality.Checks = quality.Checks(), mode: str = "incremental",
    ts_col: str = "ingestion_timestamp", late: filters.Late | None = None,
    log: EventLog | None = None,
) -> Entry:
    """Read and clean the input once into a folder of the batch, and check it.

    The batch is in the ledger once its rows lie there whole and have passed the gate."""
    spark = bronze.sparkSession
    log, issues = log or EventLog(batch_id, table), []
    try:
        log.add("INFO", "Load begins", mode=mode, level=checks.level)
        source = bronze
        if mode == "incremental":
            source = filters.newer_than(bronze, ts_col, standing.mark)
            if late is not None and standing.mark is not None:
                source = source.unionByName(late.rows(
                    bronze, ts_col, standing.mark, loaded(spark, lake, table, standing)))
        ts_name, = projections.normalize_names(source.select(ts_col)).columns
        folder = f"{lake.table('_staging', table)}/{uuid.uuid4().hex}"
        tagged = quality.convention_tagged(standardize(source, batch_id)).withColumn(
            "_rejected", F.size("failed_rules") > 0)
        if mode == "incremental" and standing.silver is not None:
            known = standing.silver
            plain = tagged.select([c for c in tagged.columns if c not in _VERDICT])
            for change in schema_changes(spark, known, plain):
                log.add("WARNING", "Schema changed", **change)
            tagged = tables.typed(tagged, known)
        arrived, mark = _write_staged(tagged, folder, ts_name)
        if mode == "incremental":  # late rows alone do not set the time back
            mark = filters.later_mark(standing.mark, mark, source.schema[ts_col].dataType)
        staged = tables.plain(tagged.schema)
        if arrived or mode == "full":
            valid = spark.read.schema(staged).parquet(folder).filter("NOT _rejected").drop(*_VERDICT)
            wanted = quality.usual_checks(valid.columns, checks)
            issues = quality.gate(quality.check(valid, wanted), wanted.level)
        for issue in issues:
            log.add("WARNING", issue)
        if not arrived and mode != "full":
            log.add("INFO", "Nothing new to load")
        silver = T.StructType([f for f in staged.fields if f.name not in _VERDICT])
        quarantine = T.StructType([*[f for f in staged.fields if f.name != "_rejected"],
                                   T.StructField("quarantine_timestamp", T.TimestampType())])
        if mode == "incremental":
            silver = tables.merged_schema(standing.silver or silver, silver)
            quarantine = tables.merged_schema(standing.quarantine or quarantine, quarantine)
        return ledger_of(spark, lake, table).add(Entry(
            batch_id, STAGED, mode, folder, arrived, mark, issues=tuple(issues),
            silver=silver.json(), quarantine=quarantine.json()))
    except Exception as error:
        log.add("ERROR", f"Load stopped: {error}")
        log.save(spark, lake)
        raise


def finish(
    bronze: DataFrame, lake: LakePaths, table: str, entry: Entry, standing: Standing,
    log: EventLog,
) -> Result:
    """Publish a staged batch and log it; what a dead run did of it already is done over.

    Both tables, the lineage and the summary hold one partition per batch, which a second try
    replaces."""
    spark = bronze.sparkSession
    ledger = ledger_of(spark, lake, table)
    try:
        loads = entry.rows or entry.mode == "full"
        if entry.state == STAGED:
            written = quarantined = 0
            if loads:
                written, quarantined = publish(spark, lake, table, entry)
            entry = ledger.add(entry.now(
                PUBLISHED, written=written, quarantined=quarantined,
                published=datetime.now(timezone.utc)))
        day = sorted({*standing.today, entry.batch_id})
        together(*[lambda: save_lineage(bronze, lake, table, entry)] * bool(loads),
                 *[lambda: save_summary(spark, lake, table, entry, day)] * bool(entry.rows))
        if entry.quarantined:
            log.add("WARNING", "Rows were quarantined", records=entry.quarantined)
        log.add("SUCCESS", "Load complete", records_processed=entry.written,
                records_quarantined=entry.quarantined, processing_mode=entry.mode)
        ledger.add(entry.now(DONE, folder=None))
        remove(spark, entry.folder)
    except Exception as error:
        log.add("ERROR", f"Load stopped: {error}")
        raise
    finally:
        log.save(spark, lake)
    return Result(entry.batch_id, entry.written, entry.quarantined, list(entry.issues))


# What staged rows carry beside those of silver.
_VERDICT = ("_rejected", "failed_rules", "quarantine_reason")


def _write_staged(tagged: DataFrame, folder: str, ts_col: str) -> tuple[int, str | None]:
    """All rows with their verdict; their number and largest ingestion time."""
    seen = Observation(f"load-{uuid.uuid4().hex}")
    tagged.observe(
        seen, F.count(F.lit(1)).alias("rows"), filters.mark_of(tagged, ts_col).alias("mark"),
    ).write.partitionBy("_rejected").parquet(folder)
    values = seen.get
    return int(values.get("rows") or 0), values.get("mark")


def publish(spark: SparkSession, lake: LakePaths, table: str, entry: Entry) -> tuple[int, int]:
    """Write the staged rows of a batch to silver and quarantine: rows of each.

    All rows have one batch id, so they are written as they lie, without a shuffle."""
    columns = {f.name: f for f in [*schema_of(entry.silver).fields,
                                   *schema_of(entry.quarantine).fields]}
    columns.pop("quarantine_timestamp")
    rejected = T.StructField("_rejected", T.BooleanType())
    staged = spark.read.schema(T.StructType([*columns.values(), rejected])).parquet(entry.folder)
    valid = staged.filter("NOT _rejected").select(schema_of(entry.silver).names)
    bad = staged.filter("_rejected").withColumn("quarantine_timestamp", F.current_timestamp())
    how = "overwrite" if entry.mode == "full" else "replace"
    quarantined, written = together(
        lambda: tables.write(bad.select(schema_of(entry.quarantine).names),
                             lake.quarantine(table), how, [BATCH], spread=False),
        lambda: tables.write(valid, lake.silver(table), how, [BATCH], spread=False),
    )
    return written, quarantined


def loaded(spark: SparkSession, lake: LakePaths, table: str, standing: Standing) -> DataFrame | None:
    """All rows that were loaded, valid and rejected ones, with the columns both have."""
    parts = [spark.read.schema(schema).parquet(path) for schema, path in (
        (standing.silver, lake.silver(table)), (standing.quarantine, lake.quarantine(table)))
        if schema is not None and tables.exists(spark, path)]
    if len(parts) == 2:
        shared = [c for c in parts[0].columns if c in parts[1].columns]
        return parts[0].select(shared).unionByName(parts[1].select(shared))
    return parts[0] if parts else None


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """A table of this flow by its folder alone, from its footers; batch ids stay text."""
    return tables.read(spark, path, BATCH)


def read_silver(
    spark: SparkSession, lake: LakePaths, table: str, keys: list[str] | None = None
) -> DataFrame:
    """The silver table; with keys, the newest row of each.

    Its columns are known from the ledger.  Loads only add rows, so a changed row costs its own
    write and not that of the table.
    """
    columns = ledger_of(spark, lake, table).standing().silver
    rows = spark.read.schema(columns).parquet(lake.silver(table)) if columns else read_batches(
        spark, lake.silver(table))
    if not keys:
        return rows
    return dedup(rows, keys, [F.desc("processed_timestamp"), F.desc(BATCH)])


def save_lineage(bronze: DataFrame, lake: LakePaths, table: str, entry: Entry) -> None:
    """Record where the silver columns come from and the share of valid rows."""
    spark = bronze.sparkSession
    names = dict(zip(projections.normalize_names(bronze).columns, bronze.columns))
    total = entry.written + entry.quarantined
    record = f"{table}-{entry.batch_id}"
    row = governance.lineage_record(
        spark, f"bronze.{table}", f"silver.{table}", "bronze_to_silver", f"load_{table}", names,
        spark.sparkContext.sparkUser(), 100.0 * entry.written / total if total else 100.0,
        record, datetime.now(timezone.utc),
    )
    tables.write(row.withColumn("load", F.lit(record)),
                 lake.monitoring("data_lineage"), "replace", ["load"], spread=False)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete the staged rows of a batch that is done."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def schema_changes(spark: SparkSession, known: T.StructType, new: DataFrame) -> list[dict]:
    """Columns added, removed or of another type; at most one record per column."""
    if {f.name: f.dataType for f in known} == {f.name: f.dataType for f in new.schema}:
        return []
    old = spark.createDataFrame([], known)
    changes = quality.schema_diff(quality.schema_frame(new), quality.schema_frame(old))
    return [r.asDict() for r in changes.collect()]


def save_summary(
    spark: SparkSession, lake: LakePaths, table: str, entry: Entry, day: list[str]
) -> None:
    """Record the summary of the day's processing, from the partitions of its batches alone."""
    if not path_exists(spark, lake.silver(table)):
        return
    silver = spark.read.schema(schema_of(entry.silver)).parquet(lake.silver(table))
    row = gold.processing_summary(
        silver.filter(F.col(BATCH).isin(day)), table, entry.batch_id,
    ).withColumn("summary_timestamp", F.current_timestamp()).withColumn(
        "load", F.lit(f"{table}-{entry.batch_id}"))
    tables.write(row.coalesce(1), lake.monitoring("processing_summary"), "replace", ["load"],
                 spread=False)
