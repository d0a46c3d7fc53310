"""Quality selection by importance resampling over hashed n-gram models."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise
from tidemark.llm.minhash import _mix

WORD_BUCKETS, SHAPE_BUCKETS = 1 << 13, 1 << 12
BUCKETS = WORD_BUCKETS + SHAPE_BUCKETS
LABELS = 20_000
"""Labelled rows that the target model and the acceptance level are fitted on, at most."""
SHARP = 200.0
"""Weight of the mean log ratio against the Gumbel noise in ``select``, where the noise decides next to nothing."""
PRIOR = 8
"""N-grams of neutral evidence that each text starts with, so that a few odd words alone condemn none."""
ACCEPT = 0.9995
"""Share of good labelled documents, set aside for this, that the acceptance level lets through."""

_CHUNK = 1 << 20
"""Bytes of text that are taken apart at once."""
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By byte: whether it is white space, what it adds to the hash of a word, and its class in a shape."""
    byte = np.arange(256)
    space = (byte == 32) | ((byte >= 9) & (byte <= 13))
    upper, digit = (byte >= 65) & (byte <= 90), (byte >= 48) & (byte <= 57)
    letter = upper | ((byte >= 97) & (byte <= 122)) | (byte >= 128)
    value = np.where(letter | digit, np.where(upper, byte + 32, byte), 0).astype(np.uint64)
    kind = np.where(upper, 1, np.where(letter, 2, np.where(digit, 3, byte + 8)))
    kind[[ord(c) for c in ".,;:!?"]] = 4
    return space, value, kind.astype(np.uint64)


_SPACE, _VALUE, _KIND = _tables()


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    made = []
    for base in (_BASE, _BACK):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        made.append(np.multiply.accumulate(steps))
    return made[0], made[1]


def _grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and bucket of each n-gram of the texts between the bounds of ``data``.

    Words are runs without white space. Each gives the hash of its letters and
    digits in lower case; each pair of neighbours a hash of both shapes (first
    and last two bytes by class, length) and whether the words are the same.
    """
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    starts = np.flatnonzero(solid & (edge[:-1] | np.r_[True, ~solid[:-1]]))
    ends = np.flatnonzero(solid & (edge[1:] | np.r_[~solid[1:], True])) + 1
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    power, inverse = _powers(1 << int(len(data)).bit_length())
    run = np.r_[np.uint64(0), np.cumsum(_VALUE[data] * power[: len(data)], dtype=np.uint64)]
    word = _mix((run[ends] - run[starts]) * inverse[starts])
    size = np.minimum(ends - starts, 24).astype(np.uint64) // np.uint64(6)
    kinds = _KIND[data]
    shape = ((kinds[starts] * np.uint64(512) + kinds[ends - 1]) * np.uint64(512) + kinds[np.maximum(ends - 2, starts)]) * np.uint64(8) + size
    doc = np.searchsorted(bounds, starts, "right") - 1
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    same = (word[pair] == word[pair + 1]).astype(np.uint64)
    pairs = _mix(_mix(shape[pair]) + shape[pair + 1] * np.uint64(2) + same)
    buckets = np.r_[word % np.uint64(WORD_BUCKETS), np.uint64(WORD_BUCKETS) + pairs % np.uint64(SHAPE_BUCKETS)]
    return np.r_[doc, doc[pair]], buckets.astype(np.int64)


def grams(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and bucket of every n-gram of a column of whole texts, in pieces of about ``_CHUNK`` bytes."""
    raw = [(x or "").encode() for x in column.to_pylist()]
    at = 0
    while at < len(raw):
        stop, size = at, 0
        while stop < len(raw) and (stop == at or size + len(raw[stop]) <= _CHUNK):
            size += len(raw[stop])
            stop += 1
        bounds = np.cumsum([0, *map(len, raw[at:stop])])
        doc, bucket = _grams(np.frombuffer(b"".join(raw[at:stop]), np.uint8), bounds)
        yield doc + at, bucket
        at = stop


@dataclass(frozen=True)
class Model:
    """``ratio``: log of target over raw by bucket; ``accept``: the least log weight that counts towards k."""

    ratio: np.ndarray
    accept: float

    def log_weights(self, column: pa.Array) -> np.ndarray:
        """Scaled log importance weights; minus infinity for texts without words."""
        total, n = np.zeros(len(column)), np.zeros(len(column))
        for row, bucket in grams(column):
            total += np.bincount(row, self.ratio[bucket], len(column))
            n += np.bincount(row, minlength=len(column))
        return np.where(n > 0, SHARP * total / (n + PRIOR), -np.inf)


def _label_sample(labels: DataFrame, id_col: str, label_col: str) -> list:
    """At most ``LABELS`` labelled ids, the first by a hash; conflicting labels count as bad."""
    one = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    one = one.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("good"))
    return one.orderBy(F.xxhash64("id"), "id").limit(LABELS).collect()


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fits both generative models in one pass over all documents.

    The raw model counts the n-grams of every document, the target model
    those of labelled good ones. Tasks send a table of counts, so what comes
    back has ``2 * BUCKETS`` rows. A third of the labelled rows is set aside to place
    the acceptance level, which divides good from bad with the fewest errors
    among levels that let ``ACCEPT`` of the good ones through.
    """
    spark = docs.sparkSession
    sample = _label_sample(labels, id_col, label_col)
    train = frozenset(r["id"] for i, r in enumerate(sample) if i % 3 and r["good"] == 1)
    aside = {r["id"]: int(r["good"]) for i, r in enumerate(sample) if not i % 3}
    shared = spark.sparkContext.broadcast(train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train = shared.value
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            good = np.array([key in train for key in batch.column(0).to_pylist()], bool)
            for row, bucket in grams(batch.column(1)):
                raw += np.bincount(bucket, minlength=BUCKETS)
                target += np.bincount(bucket[good[row]], minlength=BUCKETS)
        at = np.flatnonzero(raw)
        made = [pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(target[at])]
        yield pa.RecordBatch.from_arrays(made, ["bucket", "raw", "target"])

    counted = docs.select(id_col, text_col).mapInArrow(run, "bucket int, raw long, target long")
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for r in counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    if not train:
        return Model(np.zeros(BUCKETS), float("-inf"))
    ratio = np.zeros(BUCKETS)
    for part in (slice(0, WORD_BUCKETS), slice(WORD_BUCKETS, BUCKETS)):
        ratio[part] = np.log(target[part] / target[part].sum()) - np.log(raw[part] / raw[part].sum())
    model = Model(ratio, 0.0)
    wanted = docs.where(F.col(id_col).isin(list(aside))) if len(aside) <= 100 else docs.join(
        F.broadcast(spark.createDataFrame([(x,) for x in aside], f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}")),
        id_col, "left_semi",
    )
    scored = _scored(wanted.select(id_col, text_col), model).select(id_col, "log_weight").collect()
    good = np.sort([r["log_weight"] for r in scored if aside[r[id_col]] == 1 and np.isfinite(r["log_weight"])])
    bad = np.sort([r["log_weight"] for r in scored if aside[r[id_col]] == 0 and np.isfinite(r["log_weight"])])
    return Model(ratio, _level(good, bad))


def _level(good: np.ndarray, bad: np.ndarray) -> float:
    if not len(good):
        return float("-inf")
    top = good[int(len(good) * (1 - ACCEPT))]
    levels = np.unique(np.r_[bad[bad < top] + 1e-9, top])
    wrong = np.searchsorted(good, levels) / len(good) + (len(bad) - np.searchsorted(bad, levels)) / max(1, len(bad))
    best = levels[np.flatnonzero(wrong <= wrong.min() + 1e-12)]
    below = bad[bad < best[0]]
    return float((best[0] + top) / 2 if len(below) else top - 1.0)


def _scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``log_weight``, in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            weights = pa.array(model.log_weights(batch.column(at)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, weights], [*batch.schema.names, "log_weight"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "log_weight")
    return docs.drop("log_weight").mapInArrow(run, f"{kinds}, log_weight double")


def _gumbel(id_col: str, *more: str | F.Column) -> F.Column:
    """Gumbel noise from a hash of the id and what else is given: the same in every run."""
    u = (F.pmod(F.xxhash64(F.col(id_col), F.lit("gumbel"), *more), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(-F.log(u))


def _kth(keys: DataFrame, k: int) -> float:
    """The k-th highest ``key``, by histograms that close in on it; at most 4096 counts come back each time."""
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    if low is None or k <= 0:
        return float("inf")
    above = 0
    while high - low > 1e-7:
        width = (high - low) / 4096
        bucket = F.least(F.lit(4095), F.floor((F.col("key") - low) / width)).cast("int")
        inside = keys.where((F.col("key") >= low) & (F.col("key") <= high)).groupBy(bucket.alias("bucket")).count()
        counts = np.zeros(4096, np.int64)
        for r in inside.collect():
            counts[r["bucket"]] = r["count"]
        reach = above + counts[::-1].cumsum()[::-1]
        b = int(np.flatnonzero(reach >= k).max(initial=0))
        above = int(reach[b] - counts[b])
        low, high = low + b * width, low + (b + 1) * width
        if counts[b] <= 1:
            break
    return low


def resample(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    share: float = 0.5, temperature: float = 0.05, seed: int = 0,
) -> DataFrame:
    """``id_col, log_weight, draw_key, kept`` for every row of ``docs``.

    The log importance weight of a document is the mean log ratio of a target
    and a raw model over its hashed n-grams, divided by ``temperature``. Gumbel
    noise is added, and the k highest keys are drawn: a sample of k without
    replacement, in which each document comes next with a chance in proportion
    to the exponential of its weight. k is ``share`` of the documents with words,
    rounded down. The noise is a hash of id, text and ``seed``, so results repeat.

    Texts without words (null, empty, white space) have the weight minus
    infinity and are never drawn. Without any good label all weights are 0 and
    the draw is an even one. Repeated rows have one key and are drawn alike; keys within
    1e-7 of the k-th one count as ties, and ties are all drawn. Other columns
    are not read; an empty table gives no rows.
    """
    scored = _scored(docs.select(id_col, text_col), fit(docs, labels, id_col, text_col, label_col), text_col)
    weight = F.col("log_weight") / F.lit(SHARP * temperature)
    return draw(scored.withColumn("log_weight", weight), share, seed, id_col, text_col)


def draw(weighed: DataFrame, share: float, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Gumbel top-k of rows with a ``log_weight``; the text only takes part in the noise."""
    key = F.col("log_weight") + _gumbel(id_col, text_col, F.lit(seed))
    keyed = materialise(weighed.select(id_col, "log_weight", key.alias("draw_key")), "weights")
    real = keyed.where(F.col("log_weight") > float("-inf")).withColumnRenamed("draw_key", "key")
    least = _kth(real, int(share * real.count()))
    return keyed.withColumn("kept", (F.col("log_weight") > float("-inf")) & (F.col("draw_key") >= F.lit(least)))


def _threshold(scored: DataFrame, model: Model) -> float:
    real = scored.where(F.col("log_weight") > float("-inf")).withColumnRenamed("draw_key", "key")
    k = real.where(F.col("log_weight") >= model.accept).count()
    return _kth(real, k)


def select(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The rows of ``docs`` of good quality, with their own columns only.

    A classifier by the same two models: k is the number of documents whose
    weight reaches the level fitted on labelled rows, and weights are so sharp that
    the draw takes in effect those above it. Clean documents stay, unlike in
    ``resample``, which thins them out too. Texts without words go; without
    any good label all documents with words stay; an empty table gives no rows.

    Weights are computed for the level and once more for the selection, which
    needs no join of the texts.
    """
    model = fit(docs, labels, id_col, text_col, label_col)
    scored = _scored(docs.select(id_col, text_col), model, text_col)
    scored = materialise(scored.select("log_weight", (F.col("log_weight") + _gumbel(id_col)).alias("draw_key")), "weights")
    least = _threshold(scored, model)
    return _scored(docs, model, text_col).where(F.col("log_weight") + _gumbel(id_col) >= F.lit(least)).select(*docs.columns)
