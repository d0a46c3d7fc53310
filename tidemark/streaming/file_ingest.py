"""Files that keep arriving in a directory, staged once each.

The checkpoint of the stream remembers the files, so a run picks up exactly
those that came since the last one and then stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.ledger import Outcome, from_micros
from tidemark.plans.mappings import Mapping
from tidemark.plans.staging import Warehouse, extract_spec, stage_rows


def landed_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "csv",
    pattern: str | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    reader = (
        spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    )
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def ingest_available(
    wh: Warehouse, files: DataFrame, table: str, mapping: Mapping, checkpoint: str,
    mark_column: str | None = None,
) -> StreamingQuery:
    """Stages everything that has landed, then stops.

    A micro-batch is a run of the ledger, named by the checkpoint folder and
    the number of the batch, so later loads see it as any other batch. If it is
    repeated after a failure the run is resumed, or skipped where it had
    succeeded: each row is staged once. Without ``mark_column`` the table
    keeps its mark.
    """

    spec = extract_spec(f"stream_{table}", "stream", checkpoint, table, "incremental")

    def stage(batch: DataFrame, epoch: int) -> None:
        def work(job_id: int) -> Outcome:
            mark = wh.ledger.last_mark("staging", table, "extract")
            return stage_rows(wh, spec, batch, mapping, job_id, mark_column, mark)

        wh.run(spec, f"stream {checkpoint}", from_micros(epoch), work)

    query = (
        files.writeStream.foreachBatch(stage)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
