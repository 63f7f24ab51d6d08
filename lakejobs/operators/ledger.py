"""The ledger of a table's loads: how far each batch got, kept beside the logs.

A batch is staged (its input lies whole in a folder of its own and passed the gate), then
published (silver and quarantine hold it), then done (it is logged). Each step adds one row
behind what it tells, so a run that dies is taken up at the last row written. A row also carries
the columns of both tables and the time loaded up to, so a load opens no file of earlier loads.
One load of a table runs at a time.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.operators import tables
from lakejobs.schemas import LOAD_LEDGER
from lakejobs.session import path_exists

STAGED, PUBLISHED, DONE = "staged", "published", "done"

class LoadFinished(ValueError):
    """A batch id that is done already was given again."""


@dataclass(frozen=True)
class Entry:
    """One row of the ledger."""

    batch_id: str
    state: str
    mode: str
    folder: str | None = None
    rows: int = 0
    mark: str | None = None
    written: int = 0
    quarantined: int = 0
    issues: tuple[str, ...] = ()
    silver: str | None = None
    quarantine: str | None = None
    published: datetime | None = None

    def now(self, state: str, **changes: object) -> Entry:
        return replace(self, state=state, **changes)


@dataclass(frozen=True)
class Standing:
    """What the ledger says: the batch's own last row, batches that did not end, where the next
    load begins, the columns of both tables, and the batches published on the day."""

    own: Entry | None = None
    open: tuple[Entry, ...] = ()
    mark: str | None = None
    silver: T.StructType | None = None
    quarantine: T.StructType | None = None
    today: tuple[str, ...] = ()


def schema_of(text: str | None) -> T.StructType | None:
    return T.StructType.fromJson(json.loads(text)) if text else None


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, entry: Entry) -> Entry:
        cells = asdict(entry) | {"at": datetime.now(timezone.utc)}
        tables.few_rows(self.spark, [cells], LOAD_LEDGER).write.mode("append").parquet(self.path)
        return entry

    def standing(self, batch_id: str | None = None) -> Standing:
        """What the ledger says to a batch, in one pass over the last rows of all batches.

        Marks and columns are those of the batch published last; of the batches that are done,
        only the names of today's are taken out."""
        if not path_exists(self.spark, self.path):
            return Standing()
        rows = self.spark.read.schema(LOAD_LEDGER).parquet(self.path)
        last = rows.groupBy("batch_id").agg(
            F.max_by(F.struct(*LOAD_LEDGER.names), "at").alias("e"))
        published = F.when(F.col("e.state") != STAGED, F.col("e.published"))
        wanted = (F.col("e.state") != DONE) | (F.col("batch_id") == batch_id)
        day = datetime.now(timezone.utc).date()
        found = last.agg(
            F.collect_list(F.when(wanted, F.col("e"))).alias("entries"),
            F.max_by("e.silver", published), F.max_by("e.quarantine", published),
            F.max_by("e.mark", F.when(F.col("e.mark").isNotNull(), published)),
            F.collect_list(F.when(F.to_date(published) == F.lit(day), F.col("batch_id"))),
        ).first()
        entries = [self._entry(r) for r in sorted(found.entries, key=lambda r: r.at)]
        return Standing(
            next((e for e in entries if e.batch_id == batch_id), None),
            tuple(e for e in entries if e.state != DONE), found[3], schema_of(found[1]),
            schema_of(found[2]), tuple(found[4]))

    @staticmethod
    def _entry(row) -> Entry:
        cells = row.asDict()
        cells.pop("at")
        return Entry(**cells | {"issues": tuple(cells["issues"] or ())})
