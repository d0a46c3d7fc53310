"""Near-duplicate vectors: an index of pivot permutations, confirmed by cosine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_group, materialise
from tidemark.llm.components import components
from tidemark.llm.topk import _matrix

NEAREST = 8
"""Pivots that describe a vector, the nearest first."""
LISTS = 4
"""Of these, the pivots in whose lists a vector stands."""
SHARED = 2
"""Pivots that two vectors must share of their ``NEAREST``."""
MOST_PIVOTS = 4096
APART = 0.7
"""Pivots are no closer to each other than this cosine, else a dense group would spread over its own pivots."""
BLOCK = 1024


def _spread(units: list[np.ndarray]) -> list[np.ndarray]:
    """The points in order, without those close to one kept before."""
    kept: list[np.ndarray] = []
    for unit in units:
        peers = [k for k in kept if len(k) == len(unit)]
        if not peers or (np.stack(peers) * unit).sum(axis=1).max() < APART:
            kept.append(unit)
    return kept


def _described(vectors: DataFrame, pivots: np.ndarray, kind: str) -> DataFrame:
    """``key, unit, near``: unit vector in doubles and its nearest pivots, both as bytes."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for size, (at, matrix) in _matrix(batch.column(1)).items():
                matrix = matrix.astype(np.float64)
                units = matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
                here = np.flatnonzero([len(p) == size for p in table])
                near = np.full((len(at), NEAREST), -1, "<i4")
                if len(here):
                    score = units @ np.stack([table[i] for i in here]).T
                    n = min(NEAREST, len(here))
                    order = np.argsort(-score, axis=1, kind="stable")[:, :n]
                    near[:, :n] = here[order]
                columns = [batch.column(0).take(pa.array(at)), *(pa.array([x.tobytes() for x in y], pa.binary()) for y in (units, near))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "unit", "near"])

    return vectors.mapInArrow(run, f"key {kind}, unit binary, near binary")


def _links(members: DataFrame, least: float, kind: str) -> DataFrame:
    """Per tile of a pivot's list: ``key, other, n`` with the copies a member links with there, and a forest of links.

    A pair counts in the list of the smallest pivot that both stand under, and
    there in one tile, so sums over all tiles count it once.
    """

    def of_group(unit, near, copies, own, pivot):
        mine = near[:, :LISTS]
        shared = np.zeros((len(unit), len(unit)), np.int16)
        for x in range(NEAREST):
            for y in range(NEAREST):
                shared += (near[:, x][:, None] == near[:, y][None, :]) & (near[:, x] >= 0)[:, None]
        ok = shared >= min(SHARED, int((near >= 0).sum(axis=1).min()))
        for x in range(LISTS):  # a smaller pivot in both lists has the pair
            lower = (mine[:, x] >= 0) & (mine[:, x] < pivot)
            if lower.any():
                ok &= ~(lower[:, None] & (mine[:, x][:, None, None] == mine[None]).any(axis=2))
        if (own != own[0]).any():
            ok &= own[:, None] != own[None, :]
        np.fill_diagonal(ok, False)
        ok &= unit @ unit.T >= least
        near_any = np.flatnonzero(ok.any(axis=1))
        linked = (ok[near_any] * copies[None, :]).sum(axis=1)
        return near_any, forest(ok, near_any), linked

    def forest(ok, nodes):
        """For each node a parent in a spanning forest of the links, itself at roots."""
        parent = np.arange(len(ok))
        seen = np.zeros(len(ok), bool)
        for start in nodes:
            if seen[start]:
                continue
            seen[start], edge = True, np.array([start])
            while len(edge):
                onward = []
                for x in edge:
                    new = np.flatnonzero(ok[x] & ~seen)
                    seen[new], parent[new] = True, x
                    onward.append(new)
                edge = np.concatenate(onward)
        return parent[nodes]

    def work(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        copies, own, pivots = (table.column(x).to_numpy() for x in ("copies", "own", "pivot"))
        unit, near = table.column("unit").to_pylist(), table.column("near").to_pylist()
        keys = table.column("key")
        for lo, hi in zip(starts[:-1], starts[1:], strict=True):
            if hi - lo < 2:
                continue
            sizes = np.array([len(x) for x in unit[lo:hi]])
            for size in np.unique(sizes):
                at = lo + np.flatnonzero(sizes == size)
                units = np.frombuffer(b"".join(unit[i] for i in at), np.float64).reshape(len(at), -1)
                nears = np.frombuffer(b"".join(near[i] for i in at), "<i4").reshape(len(at), -1)
                i, parent, n = of_group(units, nears, copies[at], own[at], pivots[lo])
                if len(i):
                    a, b = (keys.take(pa.array(at[x])).combine_chunks() for x in (i, parent))
                    yield pa.RecordBatch.from_arrays([a, b, pa.array(n.astype(np.int64))], ["key", "other", "n"])

    return by_group(members, "g", work, f"key {kind}, other {kind}, n long")


def near_vectors(
    rows: DataFrame, least: float = 0.95, pivots: int | None = None, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """One row per row of ``rows``: ``id_col, n_links, component_id, kept``; links have a cosine of at least ``least``.

    Equal vectors are one class and link without being paired. Reference
    points are a bounded sample of the classes: about four times the root of
    their number, at most ``MOST_PIVOTS``, the first by a hash, without those
    close to one before. A class is
    described by its ``NEAREST`` pivots in order and stands in the inverted
    lists of the first ``LISTS``; two classes of a list that share ``SHARED``
    pivots are compared by cosine in doubles. Lists are cut into blocks and
    each pair of blocks is a task, so no list is held whole and none is cut
    short. Every row is indexed; a link is missed where two vectors stand in no
    list together or share fewer than ``SHARED`` pivots (recall of links
    against brute force: 0.9984 and 0.9999 on two tables, see the README).

    ``n_links`` counts the other rows linked directly, copies included;
    ``component_id`` is the smallest id that links reach. Vectors that are
    null, empty or zero or hold null or non-finite components link with
    nothing. Vectors of different lengths don't link. Rows with a null id count
    as links but lend no id. Repeated rows are vectors of their own. Other
    columns are not read; an empty table gives no rows.
    """
    spark = rows.sparkSession
    x = F.col(vec_col)
    fine = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    fine &= F.exists(x, lambda v: v != 0)
    base = rows.select(F.col(id_col).alias("id"), x.alias("vec"), F.coalesce(fine, F.lit(False)).alias("fine"))
    base = base.withColumn("key", F.when(F.col("fine"), F.md5(F.to_json(F.struct(F.transform("vec", lambda v: v + 0.0))).cast("binary"))))
    classes = base.where("fine").groupBy("key").agg(
        F.min("id").alias("least"), F.count("*").alias("copies"), F.min("vec").alias("vec")
    )
    classes = materialise(classes, "classes")
    n = classes.count()
    wanted = pivots or min(MOST_PIVOTS, max(16, int(4 * n**0.5)))
    picked = classes.select("vec").orderBy(F.xxhash64("key"), "key").limit(wanted).collect()
    table = [np.array(r["vec"], np.float64) for r in picked]
    table = _spread([p / np.sqrt((p * p).sum()) for p in table])
    near = _described(classes.select("key", "vec"), table, "string")
    facts = materialise(near.join(classes.select("key", "copies"), "key"), "index")
    ids = range(LISTS)
    pivot = [F.expr(f"cast(conv(hex(reverse(substring(near, {4 * i + 1}, 4))), 16, 10) as long)") for i in ids]
    listed = facts.select("key", "unit", "near", "copies", F.explode(F.array_distinct(F.array(*pivot))).alias("pivot"))
    listed = listed.where(F.col("pivot") < len(table))
    sizes = listed.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    listed = listed.join(F.broadcast(sizes), "pivot")
    listed = listed.withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    listed = listed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tile = F.xxhash64("pivot", F.least("own", "other"), F.greatest("own", "other"))
    found = materialise(_links(listed.withColumn("g", tile).drop("blocks", "other"), least, "string"), "links")
    roots = components(found.select(F.col("key").alias("a"), F.col("other").alias("b")))
    direct = found.groupBy("key").agg(F.sum("n").alias("n"))
    named = classes.select("key", "least", "copies").join(roots.withColumnRenamed("node", "key"), "key", "left")
    named = materialise(named.withColumn("root", F.coalesce("root", "key")).join(direct, "key", "left"), "named")
    firsts = named.groupBy("root").agg(F.min("least").alias("component_id"))
    links = F.coalesce("n", F.lit(0)) + F.col("copies") - 1
    named = named.join(firsts, "root").select("key", "component_id", links.alias("n_links"))
    out = base.where("fine").join(named, "key").select("id", "n_links", "component_id")
    alone = base.where("not fine").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = out.unionByName(alone)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", kept.alias("kept"))
