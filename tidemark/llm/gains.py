"""Importance resampling towards a target distribution, by hashed word windows and summed gains."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from tidemark.llm.common import from_column, materialise, shuffle_parts, texts

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
"""What stands between words, in lower-cased text: ASCII other than digits and small letters."""
SPAN = 1 << 16
"""Characters that are split at once; a piece ends in a gap, so every word is whole."""
CELLS = 4096
"""Cells of the score histogram that bounds the draw."""

_GAP = re.compile(GAP)


@dataclass(frozen=True)
class Setup:
    """``longest``: words in the longest feature; ``buckets`` of the histograms; ``least`` words of a
    document in the draw; ``percent`` of those documents that is drawn; ``seed`` of the noise."""

    longest: int = 1
    buckets: int = 10_000
    least: int = 20
    percent: int = 10
    seed: int = 2024


def _pieces(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        stop = at + SPAN
        gap = _GAP.search(text, stop) if stop < len(text) else None
        stop = gap.start() if gap else len(text)
        yield text[at:stop]
        at = stop


def histogram(text: str, splitter: Split, setup: Setup, known: dict[str, int]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of words, the buckets that the features of a text fall into, and how many fall into each.

    The splitter drops the gaps and returns the words with their offsets. A
    feature is a window over neighbouring words; where it is one word, its
    bytes are those between the two offsets, else those of its words joined
    by one space. Windows cross from one piece of a long text into the next,
    so what is held is one piece and a histogram of bounded size. ``known``
    remembers the buckets of some words.
    """
    total, n_words = np.zeros(setup.buckets, np.int64), 0
    before: list[str] = []
    for piece in _pieces(text.encode().lower().decode()):
        words = [word for word, _ in splitter.pre_tokenize_str(piece)]
        n_words += len(words)
        made: list[int] = []
        for word in words:
            bucket = known.get(word)
            if bucket is None:
                bucket = zlib.crc32(word.encode()) % setup.buckets
                if len(known) < SPAN:
                    known[word] = bucket
            made.append(bucket)
        if setup.longest > 1:
            run = before + words
            for size in range(2, setup.longest + 1):
                first = max(0, len(before) - size + 1)
                starts = range(first, len(run) - size + 1)
                made += [zlib.crc32(" ".join(run[i : i + size]).encode()) % setup.buckets for i in starts]
            before = run[len(run) - setup.longest + 1 :] if len(run) >= setup.longest else run
        total += np.bincount(np.array(made, np.int64), minlength=setup.buckets)
    at = np.flatnonzero(total)
    return n_words, at, total[at]


def histograms(docs: DataFrame, setup: Setup, id_col: str, text_col: str) -> DataFrame:
    """``id, n_words, buckets, counts`` of every row; the two arrays have at most one entry a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, known = Split(Regex(f"{GAP}+"), "removed"), {}
        for batch in batches:
            made = [histogram(text, splitter, setup, known) for text in texts(batch.column(1))]
            n_words = pa.array([m[0] for m in made], pa.int64())
            ends = np.cumsum([0, *(len(m[1]) for m in made)]).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(ends, np.concatenate([np.empty(0, np.int64), *(m[k] for m in made)]))
                for k in (1, 2)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), n_words, *lists], ["id", "n_words", "buckets", "counts"])

    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(f"`{id_col}`").alias("id"), from_column(text_col, "string").alias("text"))
    return given.mapInArrow(run, f"id {kind}, n_words long, buckets array<long>, counts array<long>")


def bucket_totals(rows: DataFrame, setup: Setup) -> np.ndarray:
    """How many features of all rows fall into each bucket; a task sends one row a bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(setup.buckets, np.int64)
        for batch in batches:
            where, counts = (batch.column(k).flatten().to_numpy() for k in (0, 1))
            np.add.at(total, where, counts)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    total = np.zeros(setup.buckets, np.int64)
    partial = rows.select("buckets", "counts").mapInArrow(run, "bucket long, n long")
    for r in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[r["bucket"]] = r["n"]
    return total


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """By bucket, how much likelier the target is than the raw text, in thousandths of a natural logarithm."""
    size = len(raw)
    all_raw, all_target = float(raw.sum() + size), float(target.sum() + size)
    ratio = [(float(t + 1) * all_raw) / (float(s + 1) * all_target) for s, t in zip(raw.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def weights(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """``id, n_words, n_features, weight`` of every row of ``histograms``."""
    shared = rows.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            ends = batch.column("buckets").offsets.to_numpy()
            where, counts = (batch.column(k).flatten().to_numpy() for k in ("buckets", "counts"))
            ends = ends - ends[0]
            sums = [np.r_[0, np.cumsum(x)][ends] for x in (counts, gain[where] * counts)]
            made = [pa.array(s[1:] - s[:-1]) for s in sums]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_words"), *made], ["id", "n_words", "n_features", "weight"]
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def noise(id_col: str, seed: int) -> F.Column:
    """Gumbel noise from a hash of the id, in thousandths; a null id is hashed as an empty one."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def drawn(scored: DataFrame, k: int, low: int, high: int) -> tuple[DataFrame, int]:
    """The k rows of ``scored(id, score, row, ...)`` with the highest scores, ranked from 1; ties to the smaller id.

    Comes with a score: the rows at and above it are those returned, ranked or not.

    A histogram gives a score that at least k rows reach. Those rows alone are
    dealt by ranges of the order, numbered within a range and shifted by the
    sizes of the ranges before it. ``row`` tells equal rows apart, so ranges
    are even however many rows tie.
    """
    width = max(1, -(-(high - low + 1) // CELLS))
    cell = F.floor((F.col("score") - F.lit(low)) / F.lit(width)).cast("int")
    counts = {r["cell"]: r["n"] for r in scored.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()}
    reached, least = 0, low
    for c in sorted(counts, reverse=True):
        reached, least = reached + counts[c], low + c * width
        if reached >= k:
            break
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    top = scored.where(F.col("score") >= F.lit(least))
    parts = max(1, min(shuffle_parts(scored.sparkSession), reached))
    ranged = materialise(top.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()), "ranges")
    sizes = {r["range"]: r["n"] for r in ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).collect()}
    ends = np.cumsum([sizes.get(p, 0) for p in range(parts)]).tolist()
    before = F.get(F.array(*[F.lit(int(x)) for x in [0, *ends[:-1]]]), F.col("range")).cast("long")
    rank = F.row_number().over(Window.partitionBy("range").orderBy(*order)).cast("long") + before
    ranked = ranged.withColumn("rank", rank).drop("range")
    return ranked.withColumn("rank", F.when(F.col("rank") <= F.lit(k), F.col("rank"))), least


def resample(
    docs: DataFrame, target: DataFrame, setup: Setup = Setup(), id_col: str = "doc_id", text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """``id_col, n_features, weight, score, rank`` for every row of ``docs``; rank is null where a row is not drawn.

    Words are runs of digits, letters a to z (A to Z lower-cased) and
    characters beyond ASCII; features are all runs of 1 to ``setup.longest``
    words. Both tables are counted whole, by the bucket of a feature. The gain
    of a bucket compares the smoothed shares of target and raw text; the
    weight of a document is the sum of its gains, the score adds Gumbel noise
    by its id. Of the documents with ``setup.least`` words or more,
    ``setup.percent`` percent are drawn, the highest scores first: a sample
    without replacement in proportion to the exponentials of the weights.

    Texts are split once; what later steps read is a histogram of each row.
    A null or empty text has no features, weight 0, and isn't drawn. A null id
    has the noise of an empty one and comes last among ties. Repeated rows have
    equal scores and follow each other in rank. Other columns aren't read;
    with an empty ``docs`` there are no rows, with an empty ``target`` it counts
    as uniform. Only ids and numbers are sorted, in even ranges.
    """
    rows = materialise(histograms(docs, setup, id_col, text_col), "histograms")
    raw = bucket_totals(rows, setup)
    wanted = bucket_totals(histograms(target.select(F.lit(0).alias("id"), f"`{target_col}`"), setup, "id", target_col), setup)
    scored = weights(rows, gains(raw, wanted)).withColumn("score", F.col("weight") + noise("id", setup.seed))
    scored = materialise(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
    able = scored.where(F.col("n_words") >= setup.least)
    n, low, high = able.agg(F.count(F.lit(1)), F.min("score"), F.max("score")).first()
    k = setup.percent * n // 100
    rank = F.lit(None).cast("long").alias("rank")
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    if k == 0:
        return scored.select(*columns, rank)
    ranked, least = drawn(able, k, low, high)
    rest = scored.where((F.col("n_words") < setup.least) | (F.col("score") < F.lit(least)))
    return ranked.select(*columns, "rank").unionByName(rest.select(*columns, rank))
