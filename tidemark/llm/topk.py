"""Exact top-k by inner product: histograms of all scores locate each query's k-th value."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise
from tidemark.session import workspace

QUERY_BLOCK = 2048
"""Queries whose vectors go to every task at once; more queries are taken block after block."""
BUCKETS = 256
ROWS = 4096
"""Candidates scored at once."""
MOST = 1 << 61
"""Scores beyond this, on either side of zero, count as this. So do components beyond twice as much."""


def whole_vectors(rows: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``id, vec`` with components ``floor(scale * x)``; rows with a null id or a gap in the vector are left out."""
    x, edge = F.col(vec_col), F.lit(float(2 * MOST))
    big = F.transform(x, lambda v: F.floor(F.greatest(F.least(v.cast("double") * F.lit(float(scale)), edge), -edge)))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return rows.where(F.col(id_col).isNotNull() & x.isNotNull() & fine).select(F.col(id_col).alias("id"), big.alias("vec"))


def _matrix(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Vectors of a batch by their length: positions and matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.r_[0, np.cumsum(sizes)]
    found = {}
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        found[int(size)] = at, flat[starts[at][:, None] + np.arange(size)]
    return found


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles where no sum reaches 2**53, else in 64-bit integers, and in
    whole numbers of any size, cut to ``MOST`` at the end, where these could overflow."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < float(MOST):
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, -MOST, MOST).astype(np.int64)


def _scored(rows: DataFrame, queries: list[tuple[int, list[int]]], schema: str, work) -> DataFrame:
    """Runs ``work(state, qids, at, ids, scores)`` over the scores of every row; ``None`` as qids ends a task."""
    by_size: dict[int, tuple[list, list]] = {}
    for i, (_, vec) in enumerate(queries):
        group = by_size.setdefault(len(vec), ([], []))
        group[0].append(i), group[1].append(vec)
    blocks = {s: (np.array(i), np.array(v, np.int64).reshape(len(v), s)) for s, (i, v) in by_size.items()}
    own = np.array([q for q, _ in queries], np.int64)
    shared = rows.sparkSession.sparkContext.broadcast((own, blocks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, blocks = shared.value
        state: dict = {}
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for size, (at, matrix) in _matrix(batch.column(1)).items():
                if size not in blocks:
                    continue
                which, vectors = blocks[size]
                for q in range(0, len(which), 256):
                    part = which[q : q + 256]
                    scores = _dot(vectors[q : q + 256], matrix)
                    mine = own[part][:, None] == ids[at][None, :]
                    work(state, part, ids[at], scores, ~mine)
        yield from work(state, None, own, None, None)

    return rows.mapInArrow(run, schema)


def _histogram(rows: DataFrame, queries: list, low: np.ndarray, width: np.ndarray, k: int) -> DataFrame:
    """``q, bucket, n``: scores at or above ``low`` by buckets of ``width``.

    A task reports its highest buckets until they hold ``k`` scores of a
    query: lower ones can't hold the k-th of all.
    """
    shared = rows.sparkSession.sparkContext.broadcast((low, width))

    def work(state, which, ids, scores, other):
        low, width = shared.value
        if which is None:
            return report(state)
        bucket = np.floor_divide(scores - low[which][:, None], width[which][:, None])
        bucket = np.where(other & (bucket >= 0), np.minimum(bucket, BUCKETS - 1), BUCKETS)
        flat = bucket + np.arange(len(which))[:, None] * (BUCKETS + 1)
        counts = np.bincount(flat.ravel(), minlength=len(which) * (BUCKETS + 1)).reshape(len(which), -1)[:, :BUCKETS]
        state.setdefault("counts", np.zeros((len(low), BUCKETS), np.int64))[which] += counts
        return ()

    def report(state):
        if "counts" not in state:
            return
        counts = state["counts"]
        above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
        q, bucket = np.nonzero((counts > 0) & (above < k))
        yield pa.RecordBatch.from_arrays(
            [pa.array(q.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(counts[q, bucket])], ["q", "bucket", "n"]
        )

    found = _scored(rows, queries, "q int, bucket int, n long", work)
    return found.groupBy("q", "bucket").agg(F.sum("n").alias("n"))


def _refine(rows: DataFrame, queries: list, k: int, reach: int) -> np.ndarray:
    """The k-th highest score of each query, or the least possible one where there are fewer."""
    low = np.full(len(queries), -reach, np.int64)
    width = np.full(len(queries), -(-(2 * reach + 1) // BUCKETS), np.int64)
    need = np.full(len(queries), k, np.int64)
    while True:
        above = Window.partitionBy("q").orderBy(F.desc("bucket"))
        run = _histogram(rows, queries, low, width, k).withColumn("run", F.sum("n").over(above))
        needs = rows.sparkSession.createDataFrame(list(enumerate(need.tolist())), "q int, need long")
        first = run.join(F.broadcast(needs), "q").where("run >= need").groupBy("q").agg(F.max("bucket").alias("bucket"))
        found = first.collect()
        open_ = np.zeros(len(queries), bool)
        for r in found:
            low[r["q"]] += r["bucket"] * width[r["q"]]
            open_[r["q"]] = True
        low[~open_] = -reach
        if not (open_ & (width > 1)).any():
            return low
        width = np.where(open_, -(-width // BUCKETS), width)


def _keep(rows: DataFrame, queries: list, least: np.ndarray, k: int) -> DataFrame:
    """``query_id, vec_id, score`` at or above ``least``; of a task only its own first k."""
    shared = rows.sparkSession.sparkContext.broadcast(least)

    def work(state, which, ids, scores, other):
        if which is None:
            return report(state, ids)
        q, at = np.nonzero(other & (scores >= shared.value[which][:, None]))
        found = state.setdefault("found", [])
        found.append(np.stack([which[q], ids[at], scores[q, at]]))
        if sum(x.shape[1] for x in found) > 200_000:
            state["found"] = [first(found)]
        return ()

    def first(found):
        q, ids, scores = np.concatenate(found, axis=1)
        order = np.lexsort((ids, -scores, q))
        q = q[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q, "left")
        return np.stack([q, ids[order], scores[order]])[:, rank < k]

    def report(state, own):
        if state.get("found"):
            q, ids, scores = first(state["found"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[q]), pa.array(ids), pa.array(scores)], ["query_id", "vec_id", "score"]
            )

    return _scored(rows, queries, "query_id long, vec_id long, score long", work)


def exact_top_k(
    rows: DataFrame, is_query: str, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """The ``k`` highest integer inner products of each query: ``query_id, rank, vec_id, score``.

    Queries are the rows where the SQL condition ``is_query`` holds on ``id``;
    candidates are all rows with another id. All candidates are scored against
    a bounded block of queries, a histogram of the scores above the last
    bound narrows the place of each k-th value by a factor of 256, and when it
    is exact one more pass keeps what reaches it. Ties go to the smaller id.

    Scores are exact up to ``MOST``, beyond which they count as that.
    Vectors that are null or hold null or non-finite components, and rows with
    a null id, take no part; vectors of another length than the query's are no
    candidates of it; empty vectors score 0. Repeated rows are candidates
    each, and a query given by repeated rows is asked once with the first
    vector in order. Fewer than ``k`` candidates are all returned; an empty
    table gives no rows. Other columns are not read.
    """
    spark = rows.sparkSession
    vectors = materialise(whole_vectors(rows, id_col, vec_col, scale).select(F.col("id").cast("long"), "vec"), "vectors")
    asked = vectors.where(is_query).groupBy("id").agg(F.min("vec").alias("vec"))
    nth = F.row_number().over(Window.partitionBy("part").orderBy("id"))
    parts = max(1, -(-vectors.where(is_query).count() // QUERY_BLOCK) * 2)
    asked = asked.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")).withColumn("nth", nth)
    asked = materialise(asked, "queries")
    top = vectors.select(F.max(F.array_max(F.transform("vec", F.abs))).alias("x"), F.max(F.size("vec")).alias("n")).first()
    reach = min(MOST, int(top["x"] or 0) ** 2 * int(top["n"] or 0) + 1)
    # a table of one directory a block, so that the plan doesn't grow with the blocks
    store, blocks = workspace(spark, "blocks"), 0
    for part in sorted(r["part"] for r in asked.select("part").distinct().collect()):
        queries = [(r["id"], list(r["vec"])) for r in asked.where(F.col("part") == part).orderBy("id").collect()]
        for at in range(0, len(queries), QUERY_BLOCK):
            block = queries[at : at + QUERY_BLOCK]
            _keep(vectors, block, _refine(vectors, block, k, reach), k).write.parquet(f"{store}/block={blocks}")
            blocks += 1
    schema = "query_id long, vec_id long, score long"
    out = spark.read.schema(schema).parquet(store) if blocks else spark.createDataFrame([], schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = out.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
