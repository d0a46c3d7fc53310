"""Shards of nearly equal bytes by sampled splitters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.llm.common import materialise, shuffle_parts

SAMPLE = 20_000
"""Keys drawn for the splitters, at most about twice as many come back."""
SLACK = 0.004
"""A group of equal texts up to this share of a shard stays in one shard."""


def _splitters(keys: DataFrame, total: int, ranges: int) -> list[tuple[int, int]]:
    """Quantiles of a size-weighted sample of keys, in order of the key.

    A row is drawn with a chance in proportion to its size, by a hash of its
    own key, so a repeated run draws the same rows.
    """
    if total == 0:
        return []
    chance = F.col("size") * F.lit(SAMPLE / total)
    draw = F.pmod(F.xxhash64("h", "row", F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = keys.where(draw < chance).select("h", "row", F.greatest(F.lit(1.0), chance).alias("weight"))
    found = drawn.toPandas().sort_values(["h", "row"])
    if not len(found):
        return []
    reach = found["weight"].cumsum().to_numpy()
    at = np.searchsorted(reach, np.arange(1, ranges) * reach[-1] / ranges)
    return [(int(found["h"].iloc[i]), int(found["row"].iloc[i])) for i in sorted(set(at.tolist()))]


def _cuts(splitters: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Splitters moved to where a group of equal texts begins, unless several fall into the group."""
    low = -(1 << 63)
    counts = pd.Series([h for h, _ in splitters]).value_counts() if splitters else {}
    return sorted({(h, row if counts[h] > 1 else low) for h, row in splitters})


def _with_range(keys: DataFrame, cuts: list[tuple[int, int]]) -> DataFrame:
    """``range`` of each row: how many cuts are at or below its key."""
    heads = np.array([h for h, _ in cuts], np.int64)
    rows = np.array([r for _, r in cuts], np.int64)

    @pandas_udf("int")
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for h, row in batches:
            h, row = h.to_numpy(np.int64), row.to_numpy(np.int64)
            lo, hi = np.searchsorted(heads, h, "left"), np.searchsorted(heads, h, "right")
            for i in np.flatnonzero(hi > lo):
                lo[i] += np.searchsorted(rows[lo[i] : hi[i]], row[i], "right")
            yield pd.Series(lo.astype(np.int32))

    return keys.withColumn("range", place("h", "row"))


def shard_by_bytes(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8
) -> DataFrame:
    """One row per row of ``docs``: ``id_col, size, text_crc32, shard, slot``.

    ``size`` is the UTF-8 bytes of the text plus ``overhead`` (null: the
    overhead alone). Rows are ordered by a hash of the text, so equal texts
    stand together, and then by row. A size-weighted sample gives splitters
    for a few thousand ranges; ranges twice as large as planned are divided
    again by a sample of their own. Exact sizes of the ranges then give the
    place of each row on the line of all bytes, and a shard is a stretch of
    that line. A row goes where its middle lies, groups of equal texts up to
    ``SLACK`` of a shard as one, larger ones are divided. Shards differ by at
    most a document or such a group. ``slot`` numbers the rows of a shard from 0.

    Null ids, repeated rows and ties are rows like others; other columns are
    not read. Fewer rows than shards leave shards empty, an empty table gives
    no rows. A sample only places cuts: sizes and slots count all rows.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long")
    rows = docs.select(
        F.col(id_col).alias("id"), size.alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("row"),
    )
    rows = materialise(rows, "sizes")
    total, n = rows.agg(F.sum("size"), F.count("*")).first()
    total = total or 0
    ranges = max(16 * shards, 4 * shuffle_parts(spark))
    cuts = _cuts(_splitters(rows.select("h", "row", "size"), total, ranges))
    placed = _with_range(rows, cuts)
    sums = {r["range"]: r["bytes"] for r in placed.groupBy("range").agg(F.sum("size").alias("bytes")).collect()}
    over = [r for r, b in sums.items() if b > 2 * total / ranges]
    if over:
        inside = placed.where(F.col("range").isin(over)).select("h", "row", "size")
        more = _splitters(inside, sum(sums[r] for r in over), 4 * len(over))
        cuts = sorted({*cuts, *_cuts(more)})
        placed = _with_range(rows, cuts)
        sums = {r["range"]: r["bytes"] for r in placed.groupBy("range").agg(F.sum("size").alias("bytes")).collect()}
    starts, before = [], 0
    for r in sorted(sums):
        starts.append((r, before))
        before += sums[r]
    offsets = spark.createDataFrame(starts, "range int, start long")
    line = Window.partitionBy("range").orderBy("h", "row")
    group = Window.partitionBy("range", "h")
    placed = placed.join(F.broadcast(offsets), "range")
    placed = placed.withColumn("at", F.col("start") + F.sum("size").over(line) - F.col("size"))
    placed = placed.withColumn("nth", F.row_number().over(line))
    placed = placed.withColumn("group_at", F.min("at").over(group)).withColumn("group_size", F.sum("size").over(group))
    whole = F.col("group_size") <= F.lit(int(SLACK * total / shards))
    middle = F.when(whole, F.col("group_at") + F.col("group_size") / 2).otherwise(F.col("at") + F.col("size") / 2)
    shard = F.least(F.lit(shards - 1), F.floor(middle * F.lit(shards) / F.lit(max(1, total)))).cast("int")
    placed = placed.withColumn("shard", shard)
    placed = materialise(placed.select("id", "size", "text_crc32", "range", "nth", "shard"), "placed")
    pieces = placed.groupBy("range", "shard").agg(F.count("*").alias("rows"), F.min("nth").alias("first"))
    slots, used = [], {}
    for r in sorted(pieces.collect(), key=lambda r: (r["shard"], r["range"])):
        slots.append((r["range"], r["shard"], used.get(r["shard"], 0) - r["first"]))
        used[r["shard"]] = used.get(r["shard"], 0) + r["rows"]
    shifts = spark.createDataFrame(slots, "range int, shard int, shift long")
    out = placed.join(F.broadcast(shifts), ["range", "shard"])
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("nth") + F.col("shift")).alias("slot"))
