"""Changes that keep arriving, applied to a table of events in buckets.

Each micro-batch is one application of the batch form to the buckets that its
ids lie in. So the state between batches is the table itself: it survives a
restart, an id with most of the feed is spread as in the batch form, and
buckets without a change are neither read nor written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.ledger import JobSpec, Outcome, from_micros
from tidemark.plans.operational import Applied
from tidemark.plans.staging import Warehouse
from tidemark.session import materialise
from tidemark.sinks.quarantine import quarantine_rows, raw_json, write_quarantine
from tidemark.sinks.tables import Tables

SCHEMA = "operational"

Apply = Callable[[DataFrame, DataFrame], Applied]


@dataclass(frozen=True)
class KeyedTable:
    """A table of ``name`` with the column ``id``, kept in ``buckets`` of it; rows of open or failed runs don't show."""

    wh: Warehouse
    name: str
    schema: T.StructType
    buckets: int = 64

    @property
    def tables(self) -> Tables:
        root = self.wh.tables.root
        return Tables(self.wh.spark, root, self.wh.ledger.unfinished, {self.name: ("id", self.buckets)})

    def create(self, rows: DataFrame) -> None:
        """The rows that the feed starts from; a table that is there stays as it is."""
        if not self.tables.exists(self.name):
            self.tables.replace(self.name, rows.select(*self.schema.fieldNames()), run=0)

    def read(self) -> DataFrame:
        return self.tables.read(self.name, self.schema)

    def rejected(self) -> DataFrame:
        """``job_id, rule, error_message, raw`` of the changes that broke a rule."""
        path, kinds = f"{self.wh.quarantine}/{self.name}", "ts STRING, job_id INT, rule STRING, error_message STRING, raw STRING"
        fs, target = self.tables._fs(path)
        if not fs.exists(target):
            return self.wh.spark.createDataFrame([], kinds).drop("ts")
        hidden = sorted(self.wh.ledger.unfinished())
        return self.wh.spark.read.schema(kinds).json(path).where(~F.col("job_id").isin(hidden)).drop("ts")


def follow(target: KeyedTable, feed: DataFrame, apply: Apply, checkpoint: str) -> StreamingQuery:
    """Applies all changes that have arrived, then stops; called again, it goes on after them.

    ``feed`` is a stream of changes, ``apply(rows, changes)`` the batch form
    (such as ``feed_events`` with its rules). Changes of an id must arrive in
    the order of ``seq``: those of a later micro-batch come after those of an
    earlier one, within a micro-batch any order will do. With this, however the
    feed is cut, table and rejected changes are those of the batch form over all of it.

    A micro-batch is a run of the ledger, named by the checkpoint folder and
    the number of the batch. Its copies of buckets count with its success, so a
    batch that fails half-way leaves the table as it was, and one that
    is repeated after it succeeded is skipped. A batch without rows changes
    nothing. A bucket that loses its last row gets an empty copy.
    """
    spec = JobSpec(f"feed_{target.name}", "feed", "stream", checkpoint, SCHEMA, target.name, "incremental")
    wh = target.wh

    def batch(changes: DataFrame, epoch: int) -> None:
        def work(job_id: int) -> Outcome:
            tables = target.tables
            arrived = materialise(changes, "feed")
            touched = [r[0] for r in arrived.select(tables.bucket(target.name)).distinct().collect()]  # no more than buckets
            if not touched:
                return Outcome("success", job_id)
            rows = tables.read(target.name, target.schema, touched)
            done = apply(rows, arrived)
            seen = tables.replace_buckets(
                target.name, done.table.select(*target.schema.fieldNames()), job_id, buckets=touched
            )
            bad = done.rejected.select("error_message", raw_json(arrived.columns).alias("raw"))
            write_quarantine(
                quarantine_rows(bad, job_id, spec.task_id, wh.run_ts), f"{wh.quarantine}/{target.name}", job_id
            )
            return Outcome("success", job_id, arrived.count(), seen["rows"])

        wh.run(spec, f"stream {checkpoint}", from_micros(epoch), work)

    query = (
        feed.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
