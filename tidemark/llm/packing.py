"""Packing of tokenised documents into sequences: cutting stock by column generation."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.bpe import encode, encoding
from tidemark.llm.common import materialise, shuffle_parts, texts

PRICINGS = 400
"""Columns generated at most; what the rounded program leaves over is packed without loss anyway."""
WASTE = 2
"""Tokens of padding that a pattern may have."""


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def tokenize(text: str, path: str, ranks: str | None, pattern: str | None) -> np.ndarray:
    """Ids of a text as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    With a rank file of the same vocabulary the ids come from there, which
    takes a fifth of the time; a text with a special token of the tokenizer
    goes to the tokenizer itself.
    """
    if ranks is None or "<|" in text:
        return np.array(_tokenizer(path).encode(text, add_special_tokens=False).ids, dtype="<u4")
    return encode(encoding(ranks, pattern), text)


def tokenized(
    docs: DataFrame, path: str, capacity: int, end_id: int = 0, ranks: str | None = None, pattern: str | None = None
) -> DataFrame:
    """``id, doc_tokens, crcs, rest``: length with the end id, CRC-32 of the full pieces, ids after those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, crcs, rests = [], [], []
            for text in texts(batch.column(1)):
                ids = np.append(tokenize(text, path, ranks, pattern), np.uint32(end_id)).astype("<u4")
                full = len(ids) // capacity * capacity
                sizes.append(len(ids))
                crcs.append([zlib.crc32(ids[i : i + capacity].tobytes()) for i in range(0, full, capacity)])
                rest = ids[full:]
                rests.append((b"2" + rest.astype("<u2").tobytes()) if rest.max(initial=0) < 65536 else b"4" + rest.tobytes())
            made = [pa.array(sizes, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(rests, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["id", "doc_tokens", "crcs", "rest"])

    kind = docs.schema[0].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, doc_tokens long, crcs array<long>, rest binary")


def _price(values: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[float, dict[int, int]]:
    """The pattern of the highest value: unbounded knapsack over the lengths."""
    best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    of_length = np.full(capacity + 1, -1.0)
    index = np.full(capacity + 1, -1)
    of_length[lengths], index[lengths] = values, np.arange(len(lengths))
    for c in range(1, capacity + 1):
        gain = of_length[1 : c + 1] + best[c - 1 :: -1][:c]
        k = int(gain.argmax())
        if gain[k] > best[c - 1] + 1e-12:
            best[c], take[c] = gain[k], k + 1
        else:
            best[c] = best[c - 1]
    pattern: dict[int, int] = defaultdict(int)
    c = capacity
    while c > 0:
        if take[c] < 0:
            c -= 1
            continue
        pattern[int(index[take[c]])] += 1
        c -= take[c]
    return float(best[capacity]), dict(pattern)


def cutting_stock(counts: dict[int, int], capacity: int, pricings: int = PRICINGS) -> list[tuple[dict[int, int], float]]:
    """Patterns (length: how often) and how many sequences of each, by the linear program.

    Minimises the sequences that hold ``counts[length]`` pieces of each length
    exactly. It starts from pairs that fill a sequence, prices new columns by a
    knapsack over the duals, and stops when none is worth more than a sequence,
    when the bound says that 0.1 % is left to gain, or after ``pricings``.
    """
    lengths = np.array(sorted(x for x, n in counts.items() if n > 0 and 0 < x <= capacity), int)
    if not len(lengths):
        return []
    at = {int(x): i for i, x in enumerate(lengths)}
    need = np.array([counts[int(x)] for x in lengths], float)
    m = len(lengths)
    columns = [{i: max(1, capacity // int(x))} for x, i in at.items()]
    for x, i in at.items():
        j = at.get(capacity - x)
        if x > capacity - x and j is not None:
            if need[i] <= need[j]:
                columns[i] = {i: 1, j: 1}
            else:
                columns[j] = {i: 1, j: 1}
    inverse, amount = np.zeros((m, m)), need.copy()
    for k in range(m):
        inverse[k, k] = 1 / columns[k][k]
    for k in range(m):
        for j in columns[k].keys() - {k}:
            inverse[j, k] = -inverse[j, j]
            amount[j] -= need[k]
    amount *= inverse.diagonal()
    for _ in range(pricings):
        duals = inverse.sum(axis=0)
        value, pattern = _price(np.maximum(duals, 0), lengths, capacity)
        if value <= 1 + 1e-9 or amount.sum() <= 1.001 * (need * np.maximum(duals, 0)).sum() / value:
            break
        step = sum(n * inverse[:, i] for i, n in pattern.items())
        ratio = np.where(step > 1e-9, np.maximum(amount, 0) / np.where(step > 1e-9, step, 1), np.inf)
        k = int(ratio.argmin())
        if not np.isfinite(ratio[k]):
            break
        amount = amount - ratio[k] * step
        amount[k] = ratio[k]
        row = inverse[k] / step[k]
        inverse = inverse - step[:, None] * row
        inverse[k] = row
        columns[k] = pattern
    return [({int(lengths[i]): n for i, n in c.items()}, max(0.0, float(a))) for c, a in zip(columns, amount, strict=True)]


def _plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple], list[tuple], int, int]:
    """Slots of the rounded patterns, the stream of the rest, its first sequence, and the first free sequence.

    A slot run ``(length, first, last, times, sequence, offset)`` serves the
    pieces of ranks ``first`` to ``last`` of a length, ``times`` to a sequence.
    """
    left = dict(counts)
    used: dict[int, int] = defaultdict(int)
    slots, sequence = [], 0
    for pattern, amount in cutting_stock(counts, capacity):
        full = sum(x * n for x, n in pattern.items())
        whole = int(min([amount + 1e-6, *(left[x] // n for x, n in pattern.items())]))
        if whole < 1 or capacity - full > WASTE:
            continue
        offset = 0
        for x, n in sorted(pattern.items()):
            slots.append((x, used[x], used[x] + n * whole - 1, n, sequence, offset))
            used[x] += n * whole
            left[x] -= n * whole
            offset += n * x
        sequence += whole
    stream, position = [], 0
    for x in sorted(left):
        if left[x]:
            stream.append((x, used[x], position))
            position += x * left[x]
    return slots, stream, sequence, position


def _tail(position: int, capacity: int) -> list[int]:
    """Ends of the last sequences of the stream: full ones, then powers of two."""
    done = position // capacity * capacity
    ends = []
    for bit in reversed(range(capacity.bit_length())):
        if (position - done) >> bit & 1:
            ends.append((ends[-1] if ends else done) + (1 << bit))
    return ends


def pack(
    docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    ranks: str | None = None, pattern: str | None = None,
) -> DataFrame:
    """Packs whole documents into sequences of at most ``capacity`` tokens; one row per piece.

    ``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset``. A
    document is its ids and ``end_id``. Full pieces of ``capacity`` ids are
    sequences of their own; what remains of each document is an item of fewer
    ids. The histogram of item lengths (fewer than ``capacity`` counts) is all
    that the linear program sees. Its patterns are rounded down, and of those
    with at most ``WASTE`` free places items take slots by their rank among
    the items of their length. Items beyond these slots are laid end to end,
    cut at multiples of ``capacity``, and the last incomplete sequence is cut
    into powers of two, which need no padding.

    Ranks are counted in many slices of each length, so that a length which
    very many documents share is no single task. Null texts are empty and
    become the end id alone; null ids, ties and repeated rows are documents of
    their own; other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    items = tokenized(base, path, capacity, end_id, ranks, pattern)
    items = materialise(items.withColumn("row", F.monotonically_increasing_id()), "tokens")
    items = items.withColumn("rest_len", F.pmod("doc_tokens", F.lit(capacity)))
    sizes = items.groupBy("rest_len").agg(F.count("*").alias("n"), F.max("doc_tokens").alias("top")).collect()
    counts = {r["rest_len"]: r["n"] for r in sizes if r["rest_len"]}
    slots, stream, first, position = _plan(counts, capacity)
    total = sum(r["n"] for r in sizes)
    width = max(64, total // (4 * shuffle_parts(spark)))
    slices = spark.createDataFrame([(r["rest_len"], -(-r["n"] // width)) for r in sizes], "rest_len long, slices long")
    dealt = items.join(F.broadcast(slices), "rest_len")
    dealt = dealt.withColumn("slice", F.pmod(F.xxhash64("row"), F.col("slices"))).drop("slices")
    heads = dealt.groupBy("rest_len", "slice").agg(F.count("*").alias("n")).collect()
    starts, reach, rank = [], {}, 0
    for r in sorted(heads, key=lambda r: (r["rest_len"], r["slice"])):
        starts.append((r["rest_len"], r["slice"], reach.get(r["rest_len"], 0), rank))
        reach[r["rest_len"]] = reach.get(r["rest_len"], 0) + r["n"]
        rank += r["n"]
    starts = spark.createDataFrame(starts, "rest_len long, slice long, in_length long, overall long")
    nth = F.row_number().over(Window.partitionBy("rest_len", "slice").orderBy("row")) - 1
    ranked = dealt.withColumn("nth", nth).join(F.broadcast(starts), ["rest_len", "slice"])
    ranked = ranked.withColumns({"rank": F.col("in_length") + F.col("nth"), "overall": F.col("overall") + F.col("nth")})
    by_length: dict[int, tuple[list, tuple | None]] = {}
    for x in counts:
        by_length[x] = (sorted(s[1:] for s in slots if s[0] == x), next((s[1:] for s in stream if s[0] == x), None))
    tail, done = _tail(position, capacity), position // capacity
    fulls = first + done + len(tail)
    most = max([r["top"] // capacity for r in sizes], default=0)

    def stretches(begin: int, size: int) -> Iterator[tuple[int, int, int]]:
        """Sequence, offset and length of the parts of a stretch of the stream."""
        while size:
            k = begin // capacity
            if k < done:
                low, high, number = k * capacity, (k + 1) * capacity, first + k
            else:
                i = next(i for i, end in enumerate(tail) if begin < end)
                low, high, number = (tail[i - 1] if i else done * capacity), tail[i], first + done + i
            part = min(size, high - begin)
            yield number, begin - low, part
            begin, size = begin + part, size - part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            which = []
            columns = (batch.column(i).to_pylist() for i in range(1, 6))
            for row, (tokens, crcs, rest, rank, overall) in enumerate(zip(*columns, strict=True)):
                placed = [(i * capacity, capacity, c, fulls + overall * most + i, 0) for i, c in enumerate(crcs)]
                ids = np.frombuffer(rest[1:], "<u2" if rest[:1] == b"2" else "<u4").astype("<u4")
                if len(ids):
                    runs, flow = by_length[len(ids)]
                    begin = tokens - len(ids)
                    slot = next((s for s in runs if s[0] <= rank <= s[1]), None)
                    if slot:
                        low, _, times, sequence, offset = slot
                        k = rank - low
                        parts = [(sequence + k // times, offset + k % times * len(ids), len(ids))]
                    else:
                        parts = stretches(flow[1] + (rank - flow[0]) * len(ids), len(ids))
                    at = 0
                    for sequence, offset, size in parts:
                        placed.append((begin + at, size, zlib.crc32(ids[at : at + size].tobytes()), sequence, offset))
                        at += size
                for start, size, crc, sequence, offset in placed:
                    which.append(row)
                    for column, x in zip(out, (start, size, crc, tokens, sequence, offset), strict=False):
                        column.append(x)
            made = [pa.array(x, pa.int64()) for x in out[:6]]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which, pa.int32())), *made], names)

    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    kind = docs.schema[id_col].dataType.simpleString()
    ranked = ranked.select("id", "doc_tokens", "crcs", "rest", "rank", "overall")
    packed = ranked.mapInArrow(run, ", ".join([f"id {kind}", *(f"{x} long" for x in names[1:])]))
    return packed.withColumnRenamed("id", id_col)
