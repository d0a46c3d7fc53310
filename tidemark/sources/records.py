"""CSV files with line breaks inside quotes, read by many tasks.

Whether a line break ends a record depends on all quotes before it: it does
where their number is even. So lines are read as they are, each piece of a
file counts its quotes, and the parity at the start of a piece is that of the
pieces before it, a prefix sum over a few numbers. Lines are then put together
to records, which are parsed like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.session import materialise

PIECE_LINES = 1 << 16
"""Lines of a piece, at most; a record never holds more than the lines up to its closing quote."""


def quoted_lines(spark: SparkSession, path: str | list[str], encoding_mark: str = "\ufeff") -> DataFrame:
    """``file, piece, line, text``: the lines of all files in order.

    Spark's own line reader deals a file to tasks; the block a line comes from
    and its place there are its position. Lines end with a line feed; a
    carriage return before it stays for the caller.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    placed = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        # within a task rows are numbered as they are read; a task may read several blocks
        F.monotonically_increasing_id().alias("line"), F.col("value").alias("text"),
    )
    placed = materialise(placed, "lines")
    first = placed.groupBy("file", "block").agg(F.min("line").alias("first"))
    numbered = placed.join(first, ["file", "block"])
    piece = F.struct("block", F.floor((F.col("line") - F.col("first")) / PIECE_LINES).alias("part"))
    start = (F.col("block") == 0) & (F.col("line") == F.col("first"))
    text = F.when(start, F.regexp_replace("text", f"^{encoding_mark}", "")).otherwise(F.col("text"))
    return numbered.select("file", piece.alias("piece"), "line", text.alias("text"))


def records(lines: DataFrame, quote: str = '"') -> DataFrame:
    """``file, piece, line, text``: one row a record, under the place of its first line.

    Within a piece a running count of quotes tells which lines begin a record;
    one that began in an earlier piece is continued under the last beginning
    before it. Both carry over from piece to piece by a summary of one row a
    piece. What is gathered is the lines of one record.
    """
    n = F.regexp_count("text", F.lit(quote)).cast("long")
    counted = lines.withColumn("n", n)
    within = Window.partitionBy("file", "piece").orderBy("line")
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("seen", F.coalesce(F.sum("n").over(before), F.lit(0)))

    sums = counted.groupBy("file", "piece").agg(F.sum("n").alias("all"))
    pieces = Window.partitionBy("file").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carry = materialise(sums.select("file", "piece", F.coalesce(F.sum("all").over(pieces), F.lit(0)).alias("carry")), "quotes")
    marked = counted.join(carry, ["file", "piece"])
    begins = (F.col("seen") + F.col("carry")) % 2 == 0
    marked = marked.withColumn("begin", F.when(begins, F.struct("piece", "line")))

    last = marked.groupBy("file", "piece").agg(F.max("begin").alias("last"))
    earlier = last.select("file", "piece", F.last("last", ignorenulls=True).over(pieces).alias("open"))
    here = F.last("begin", ignorenulls=True).over(within)
    owned = marked.withColumn("begin", here).join(earlier, ["file", "piece"])
    owned = owned.withColumn("begin", F.coalesce("begin", "open"))

    whole = owned.where((F.col("begin.line") == F.col("line")) & (F.col("n") % 2 == 0))
    parts = owned.where((F.col("begin.line") != F.col("line")) | (F.col("n") % 2 != 0))
    gathered = parts.groupBy("file", "begin").agg(F.sort_array(F.collect_list(F.struct("piece", "line", "text"))).alias("parts"))
    joined = gathered.select(
        "file", F.col("begin.piece").alias("piece"), F.col("begin.line").alias("line"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"),
    )
    return whole.select("file", "piece", "line", "text").unionByName(joined)


def read_quoted_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with a header row and line breaks inside quotes; every column is text.

    The rows are those of a reader that takes each file in one task, without
    doing so. The columns are those of the first file's header, and the files
    must agree on it. Lines without any character are no records, and a quote
    that is never closed makes one record of the rest of its file.
    """
    rows = records(quoted_lines(spark, path))
    rows = rows.withColumn("text", F.rtrim("text", F.lit("\r"))).where("text <> ''")
    rows = materialise(rows, "records")
    heads = rows.groupBy("file").agg(F.min(F.struct("piece", "line", "text")).alias("head"))
    texts = [r["text"] for r in heads.select("head.text").distinct().limit(2).collect()]
    if not texts:
        return spark.createDataFrame([], T.StructType([]))
    if len(texts) > 1:
        raise ValueError(f"files differ in their header: {texts[0]!r} and {texts[1]!r}")
    names = _fields(spark, texts[0])
    first = heads.select("file", F.col("head.piece").alias("piece"), F.col("head.line").alias("line"))
    body = rows.join(first, ["file", "piece", "line"], "left_anti")
    parsed = F.from_csv("text", _ddl(names), _OPTIONS)
    return body.select(parsed.alias("row")).select("row.*")


_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}


def _ddl(names: Sequence[str]) -> str:
    quoted = [n.replace("`", "``") for n in names]
    return ", ".join(f"`{n}` STRING" for n in quoted)


def _fields(spark: SparkSession, line: str) -> list[str]:
    """The fields of one record."""
    width = line.count(",") + 1
    schema = ", ".join(f"f{i} STRING" for i in range(width))
    row = spark.range(1).select(F.from_csv(F.lit(line), schema, _OPTIONS).alias("row")).first()["row"]
    values = list(row)
    while values and values[-1] is None:
        values.pop()
    return [v if v is not None else f"_c{i}" for i, v in enumerate(values)]
