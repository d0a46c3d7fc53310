"""Parquet tables that are replaced as a whole or appended to by batch.

A table is a directory of versions, ``<name>/v=000007/``. A version counts once
its ``_READY`` marker exists, so a full replace is one atomic step for readers,
and a plan may read the old version while the new one is written. A version
written for a run names it in ``_RUN=<id>``.

A bucketed table keeps its rows in ``bucket=<n>/run=<id>/`` of its version: a
run that changes some buckets writes these anew, and of each bucket the copy of
the newest run counts.

Versions, batches and copies of runs that ``unfinished`` lists are passed over, so what
a run writes shows with its success.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Sequence
from contextlib import contextmanager

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.schemas import BUCKETS, CORE, PARTITIONS, REJECT, STAGING

READY = "_READY"
RUN = "_RUN="
EMPTY = "_EMPTY"
WRITE_BYTES = "16MB"
"""What a task of a rebalanced write gets of the shuffle, unless the session says otherwise."""
_REJECTED = T.StructField("rejected", T.BooleanType())


class Tables:
    """``bucketed`` names the column and the number of buckets of tables that are kept in buckets."""

    def __init__(
        self, spark: SparkSession, root: str, unfinished: Callable[[], Collection[int]] = tuple,
        bucketed: dict[str, tuple[str, int]] = BUCKETS,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.unfinished = unfinished
        self.bucketed = bucketed

    # -- versions -----------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        return target.getFileSystem(conf), target

    def _versions(self, name: str, ready: bool) -> list[int]:
        fs, base = self._fs(f"{self.root}/{name}")
        if not fs.exists(base):
            return []
        found = []
        for status in fs.listStatus(base):
            part = status.getPath().getName()
            if part.startswith("v=") and (not ready or self._is_ready(name, int(part[2:]))):
                found.append(int(part[2:]))
        return sorted(found)

    def _is_ready(self, name: str, version: int) -> bool:
        fs, marker = self._fs(f"{self._path(name, version)}/{READY}")
        return fs.exists(marker)

    def _path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/v={version:06d}"

    def _publish(self, name: str, version: int, run: int | None = None) -> None:
        for mark in [READY] if run is None else [f"{RUN}{run}", READY]:
            fs, marker = self._fs(f"{self._path(name, version)}/{mark}")
            fs.create(marker, True).close()

    def _run_of(self, name: str, version: int) -> int | None:
        """The run a version was written for."""
        fs, base = self._fs(self._path(name, version))
        marks = [s.getPath().getName() for s in fs.listStatus(base)]
        return next((int(m.removeprefix(RUN)) for m in marks if m.startswith(RUN)), None)

    def _current(self, name: str, run: int | None = None) -> int | None:
        """Newest version that counts; ``run`` sees its own as well."""
        hidden = set(self.unfinished()) - {run}
        for version in reversed(self._versions(name, ready=True)):
            if not hidden or self._run_of(name, version) not in hidden:
                return version
        return None

    def path(self, name: str, run: int | None = None) -> str | None:
        version = self._current(name, run)
        return None if version is None else self._path(name, version)

    def discard(self, name: str, run: int) -> None:
        """Removes what a run that did not succeed has written: its versions and its batch."""
        for version in self._versions(name, ready=False):
            path = self._path(name, version)
            fs, target = self._fs(path)
            if self._run_of(name, version) == run:
                fs.delete(target, True)
                continue
            for pattern in (f"job_id={run}", f"*/job_id={run}", f"bucket=*/run={run}"):
                _, batch = self._fs(f"{path}/{pattern}")
                for status in fs.globStatus(batch) or ():
                    fs.delete(status.getPath(), True)

    def exists(self, name: str) -> bool:
        return self.path(name) is not None

    def drop_old_versions(self, name: str, keep: int = 2) -> None:
        """Frees all but the newest versions; none of them may be in use."""
        for version in self._versions(name, ready=True)[:-keep]:
            fs, target = self._fs(self._path(name, version))
            fs.delete(target, True)

    # -- reading ------------------------------------------------------------

    def read(self, name: str, schema: T.StructType | None = None, buckets: Collection[int] | None = None) -> DataFrame:
        """The rows that count; ``buckets`` limits a bucketed table to these, others aren't opened."""
        schema = schema or STAGING.get(name) or CORE[name]
        path = self.path(name)
        if path is None:
            return self.spark.createDataFrame([], schema)
        if name in self.bucketed:
            return self._newest_copies(path, schema, buckets)
        fields = [*schema.fields, _REJECTED] if name in STAGING else schema.fields
        rows = self.spark.read.schema(T.StructType(fields)).parquet(path)
        hidden = sorted(self.unfinished()) if "job_id" in schema.fieldNames() else []
        if hidden:
            rows = rows.where(F.col("job_id").isNull() | ~F.col("job_id").isin(hidden))
        return rows.where("NOT rejected").drop("rejected") if name in STAGING else rows

    def bucket(self, name: str) -> Column:
        column, buckets = self.bucketed[name]
        return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")

    def _newest_copies(self, path: str, schema: T.StructType, buckets: Collection[int] | None) -> DataFrame:
        """The rows of a bucketed table: a filter on directories, by run and bucket."""
        fs, copies = self._fs(f"{path}/bucket=*/run=*")
        hidden, newest = set(self.unfinished()), {}
        for status in fs.globStatus(copies) or ():
            bucket, run = (int(p.rsplit("=", 1)[1]) for p in (status.getPath().getParent().getName(), status.getPath().getName()))
            if run not in hidden and (buckets is None or bucket in buckets):
                newest[bucket] = max(run, newest.get(bucket, run))
        by_run: dict[int, list[int]] = {}
        for bucket, run in newest.items():
            by_run.setdefault(run, []).append(bucket)
        fields = [*schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField("run", T.IntegerType())]
        rows = self.spark.read.schema(T.StructType(fields)).parquet(path)
        chosen = [(F.col("run") == run) & F.col("bucket").isin(here) for run, here in by_run.items()]
        return rows.where(reduce(or_, chosen, F.lit(False))).drop("bucket", "run")

    def partitions(self, name: str, *columns: str) -> list[tuple[int, ...]]:
        """The directories by whole-numbered ``columns`` of the table's current version, whichever run wrote them."""
        path = self.path(name)
        if path is None:
            return []
        fs, pattern = self._fs("/".join([path, *(f"{c}=*" for c in columns)]))
        found = [status.getPath().toString().split("/")[-len(columns) :] for status in fs.globStatus(pattern) or ()]
        return [tuple(int(part.split("=", 1)[1]) for part in parts) for parts in found]

    def rejected(self, name: str, job_id: int) -> DataFrame:
        """Rows of a batch that staging turned away: ``error_message`` and ``raw``."""
        fields = [*REJECT.fields, T.StructField("job_id", T.IntegerType()), _REJECTED]
        table = self.spark.read.schema(T.StructType(fields)).parquet(self.path(name, job_id))
        return table.where((F.col("job_id") == job_id) & F.col("rejected")).select(*REJECT.fieldNames())

    # -- writing ------------------------------------------------------------

    def replace(
        self,
        name: str,
        df: DataFrame,
        partition_by: Sequence[str] | None = None,
        measures: dict[str, Column] | None = None,
        run: int | None = None,
    ) -> dict[str, object]:
        """Writes and publishes a new version, of a ``run`` if given; returns what ``append`` returns."""
        parts = PARTITIONS.get(name, []) if partition_by is None else list(partition_by)
        version = (self._versions(name, ready=False) or [0])[-1] + 1
        if name in self.bucketed:
            parts = ["bucket", "run"]
            df = df.withColumns({"bucket": self.bucket(name), "run": F.lit(run or 0)})
        counted, counts = _counted(_spread(df, parts), measures)
        writer = counted.write.mode("overwrite")
        if parts:
            writer = writer.partitionBy(*parts)
        with _small_parts(self.spark):
            writer.parquet(self._path(name, version))
        self._publish(name, version, run)
        return counts()

    def replace_buckets(
        self, name: str, df: DataFrame, run: int, measures: dict[str, Column] | None = None,
        buckets: Collection[int] = (),
    ) -> dict[str, object]:
        """Writes new copies of the buckets that ``df`` holds whole; files of all others stay as they are.

        Those of ``buckets`` that ``df`` has no row of get an empty copy. Returns
        what ``append`` returns. The copies of a run count with its success.
        """
        path = self._path(name, self._current(name))
        df = df.withColumns({"bucket": self.bucket(name), "run": F.lit(run)})
        counted, counts = _counted(_spread(df, ["bucket"]), measures)
        (
            counted.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket", "run")
            .parquet(path)
        )
        for bucket in buckets:
            fs, copy = self._fs(f"{path}/bucket={bucket}/run={run}")
            if not fs.exists(copy):
                fs.create(self._fs(f"{path}/bucket={bucket}/run={run}/{EMPTY}")[1], True).close()
        return counts()

    def drop_old_copies(self, name: str) -> int:
        """Frees copies of buckets that a newer one of a finished run stands for; none of them may be in use."""
        path, hidden, freed = self.path(name), set(self.unfinished()), 0
        fs, copies = self._fs(f"{path}/bucket=*/run=*")
        by_bucket: dict[str, list[tuple[int, object]]] = {}
        for status in fs.globStatus(copies) or ():
            run = int(status.getPath().getName().removeprefix("run="))
            if run not in hidden:
                by_bucket.setdefault(status.getPath().getParent().getName(), []).append((run, status.getPath()))
        for found in by_bucket.values():
            for _, copy in sorted(found, key=lambda x: x[0])[:-1]:
                freed += fs.delete(copy, True)
        return freed

    def append(
        self,
        name: str,
        df: DataFrame,
        partition_by: Sequence[str] | None = None,
        measures: dict[str, Column] | None = None,
    ) -> dict[str, object]:
        """Adds the partitions of a batch to the current version.

        Partitions the batch already has are overwritten, so a retry leaves
        each row once. Returns the row count (``rows``) and any further
        ``measures`` taken while the rows are written.
        """
        parts = PARTITIONS.get(name, []) if partition_by is None else list(partition_by)
        if not parts:
            raise ValueError(f"{name} has no batch partitions to append to")
        current = self._current(name)
        version = (self._versions(name, ready=False) or [0])[-1] + 1 if current is None else current
        counted, counts = _counted(_spread(df, parts), measures)
        writer = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
        with _small_parts(self.spark):
            writer.parquet(self._path(name, version))
        if current is None:
            self._publish(name, version)
        return counts()


def _counted(df: DataFrame, measures: dict[str, Column] | None = None):
    # Taken in the writing tasks themselves, so a retried task counts once.
    seen = Observation()
    totals = [F.count(F.lit(1)).alias("rows")]
    totals += [expr.alias(name) for name, expr in (measures or {}).items()]
    return df.observe(seen, *totals), lambda: seen.get


@contextmanager
def _small_parts(spark: SparkSession) -> Iterator[None]:
    """Lets a month with many rows be written by many tasks; a write is slower than the shuffle before it."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, WRITE_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(key)


def _spread(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Files per month and not per month and task.

    A rebalance lets AQE split months that are too big for one task and join
    small ones. A batch has one job and needs none.
    """
    lead = [p for p in parts if p not in ("job_id", "rejected")]
    return df.hint("rebalance", *lead) if lead else df


def read_fact(fact: DataFrame, date_col: str, first: int, last: int) -> DataFrame:
    """Fact rows between two date keys, reading only the months they touch."""
    return fact.where(
        F.col("month_sk").between(first // 100, last // 100)
        & F.col(date_col).between(first, last)
    )
