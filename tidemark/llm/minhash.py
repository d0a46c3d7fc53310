"""Near-duplicate documents: MinHash signatures in an LSH forest, confirmed on full shingle sets.

A document is the set of its word shingles. Documents with equal sets are one
class from the start. A class has a signature of ``TREES * DEPTH`` minima and
``EXTRA`` more; a tree orders the classes by its ``DEPTH`` minima, and classes that
share the first ``LEVELS[0]`` are a region. For the early proposals only,
regions of more than ``REGION`` classes are told apart by longer prefixes; the
last round compares the regions of the first level whole, the large ones block
by block and on full sets, so what it passes on is links, not candidates. Two sets of similarity 0.8 share three minima in one of 16 trees but
for a chance of 1e-5, however large the region is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import by_group, materialise
from tidemark.llm.components import components

TREES, DEPTH = 16, 8
EXTRA = 128
"""Minima beyond those of the trees; all together estimate the similarity of candidates."""
LEVELS = (3, 5, 8)
REGION = 4096
"""Classes that share a prefix before the early proposals take a longer one."""
BLOCK = 512
"""Classes of a block; a task holds two blocks of a region at a time."""
WEIGHT = 2048
"""Shingles that count as one class in a block, so that blocks of long texts hold fewer of them."""
SHARED = 4096
"""Shingles that are counted at once when the sets of two blocks are intersected."""
SLACK = 0.1
"""How far below the limit an estimate may lie: four deviations of 256 minima at 0.8."""
NEXT = 16
"""Partners that a member outside the main component of its group proposes in the second round."""

_MASK = (1 << 64) - 1


def _constants() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.Generator(np.random.PCG64(20240229))
    a = draw.integers(0, 1 << 63, TREES * DEPTH + EXTRA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, draw.integers(0, 1 << 63, TREES * DEPTH + EXTRA, dtype=np.uint64)


_A, _B = _constants()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text.

    A-Z are lowered; words are runs of bytes other than 0x20 and 0x09-0x0D. A
    text of fewer than ``width`` words is one shingle, without words it has none.
    """
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(map(digest, words), np.uint64, len(words))
    if len(words) < width:
        return np.array([digest(b" ".join(words), len(words))], np.uint64)
    n = len(words) - width + 1
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = _mix(out + hashes[i : i + n] + np.uint64((0x9E3779B97F4A7C15 * (i + 1)) & _MASK))
    return np.unique(out)


def signature(found: np.ndarray) -> bytes:
    """16 bits of the smallest hash under each function."""
    low = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):
        part = found[at : at + 2048, None] * _A + _B
        low = np.minimum(low, part.min(axis=0))
    return (_mix(low) & np.uint64(0xFFFF)).astype("<u2").tobytes()


def _sets(docs: DataFrame, width: int, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, sigs = [], [], []
            for text in batch.column(1).to_pylist():
                found = shingle_set(text or "", width)
                sizes.append(len(found))
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                sigs.append(signature(found) if len(found) else None)
            made = [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())]
            names = ["id", "text_key", "copy_key", "n_shingles", "set_key", "sig"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), *made], names)

    return docs.mapInArrow(run, f"id {kind}, text_key long, copy_key long, n_shingles long, set_key binary, sig binary")


def _regions(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The regions of the first level, and those of the early proposals, where longer prefixes tell large ones apart.

    Both are ``g, set_key, tree, blocks, large`` of each class in each tree where it shares a region with others.
    """
    rows = classes.select("set_key", "n", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "sig")
    rows = rows.select("set_key", "tree", _weight().alias("weight"), F.expr(f"substring(sig, 1 + tree * {2 * DEPTH}, {2 * DEPTH})").alias("path"))
    whole = early = None
    for level in LEVELS:
        keyed = rows.withColumn("g", F.xxhash64("tree", F.lit(level), F.expr(f"substring(path, 1, {2 * level})")))
        sizes = keyed.groupBy("g").agg(F.count("*").alias("members"), F.sum("weight").alias("weights")).where("members > 1")
        keyed = materialise(keyed.join(sizes, "g"), f"level{level}")
        final = keyed if level == LEVELS[-1] else keyed.where(F.col("members") <= REGION)
        blocks = F.ceil(F.col("weights") / BLOCK).cast("int").alias("blocks")
        columns = ["g", "set_key", "tree", blocks, ((F.col("members") > REGION) | (F.col("weights") > BLOCK)).alias("large")]
        final = final.select(*columns)
        whole = keyed.select(*columns) if whole is None else whole
        early = final if early is None else early.union(final)
        rows = keyed.where(F.col("members") > REGION).select("set_key", "tree", "weight", "path")
        if level == LEVELS[-1] or rows.isEmpty():
            break
    return whole, early


def _weight() -> F.Column:
    return F.ceil(F.col("n") / WEIGHT).cast("long")


def _single(rows: DataFrame) -> DataFrame:
    """Each block of a large region a group of its own; each tree deals the classes anew."""
    rows = rows.withColumn("own", F.pmod(F.xxhash64("set_key", "tree"), F.col("blocks")).cast("int"))
    g = F.when(F.col("blocks") > 1, F.xxhash64("g", "own")).otherwise(F.col("g"))
    return rows.withColumn("g", g).drop("blocks", "large")


def _tiles(rows: DataFrame) -> DataFrame:
    """Deals large regions to pairs of blocks: each two classes of a region with different roots meet in a tile.

    The classes of a region's most frequent root have blocks of their own,
    which need not meet each other.
    """
    large = rows.where("blocks > 1").drop("blocks", "large")
    counts = large.groupBy("g", "root").agg(F.sum(_weight()).alias("w"))
    main = counts.groupBy("g").agg(F.max(F.struct("w", "root")).alias("main"), F.sum("w").alias("members"))
    main = main.select(
        "g", F.col("main.root").alias("most"), F.ceil((F.col("members") - F.col("main.w")) / BLOCK).cast("int").alias("others"),
        F.ceil(F.col("main.w") / BLOCK).cast("int").alias("mains"),
    )
    deal = F.xxhash64("set_key", "tree")
    inside = F.col("root") == F.col("most")
    dealt = large.join(main.where("others > 0"), "g").withColumn(
        "own", F.when(inside, F.col("others") + F.pmod(deal, F.col("mains"))).otherwise(F.pmod(deal, F.col("others"))).cast("int")
    )
    last = F.when(inside, F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1
    tiled = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    tiled = tiled.withColumn("g", F.xxhash64("g", F.least("own", "other"), F.greatest("own", "other")))
    small = rows.where("blocks = 1").drop("blocks", "large").withColumn("own", F.lit(0))
    return small.unionByName(tiled.drop("other", "most", "others", "mains"))


def _estimates(
    sig: np.ndarray, size: np.ndarray, root: np.ndarray, own: np.ndarray, least: float, ratio: float
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of each two members of a group, and which of them may be linked.

    Those have an estimate of at least ``least``, set sizes within ``ratio`` and
    different roots; in a tile of two blocks only members of different blocks count.
    """
    est = np.zeros((len(sig), len(sig)), np.float32)
    for i in range(len(sig)):
        est[i] = (sig[i] == sig).mean(axis=1)
    ok = (est >= least) & (root[:, None] != root[None, :])
    ok &= np.minimum.outer(size, size) >= ratio * np.maximum.outer(size, size)
    np.fill_diagonal(ok, False)
    if (own != own[0]).any():
        ok &= own[:, None] != own[None, :]
    return est, ok


def _columns(table: pa.Table) -> tuple[np.ndarray, ...]:
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u2").reshape(table.num_rows, -1)
    return sig, *(table.column(x).to_numpy() for x in ("n", "root", "own", "tree"))


def _candidates(members: DataFrame, least: float, ratio: float, turn: int) -> DataFrame:
    """Candidate links ``a, b, est, hub`` within each group ``g``, see ``_estimates``.

    At first from each member ``a`` to its most similar partner, and (``hub``)
    to the member that is most similar to all others. In the second turn from
    members outside the group's most frequent root to their ``NEXT`` most
    similar partners. Ties go to the member that comes first.
    """

    def of_group(sig: np.ndarray, size: np.ndarray, root: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, ...]:
        n = len(sig)
        est, ok = _estimates(sig, size, root, own, least, ratio)
        if turn == 1:
            names, at, counts = np.unique(root, return_inverse=True, return_counts=True)
            few = np.flatnonzero((at != counts.argmax()) & ok.any(axis=1))
            best = np.argsort(np.where(ok[few], -est[few], 1), axis=1, kind="stable")[:, :NEXT]
            i, j = np.repeat(few, best.shape[1]), best.ravel()
            i, j = i[ok[i, j]], j[ok[i, j]]
            return i, j, est[i, j], np.zeros(len(i), bool)
        est[~ok] = 0
        best = est.argmax(axis=1)
        i = np.flatnonzero(est[np.arange(n), best])
        hub = int(est.sum(axis=1).argmax())
        near = np.flatnonzero(ok[hub])
        i, j = np.r_[i, near], np.r_[best[i], np.full(len(near), hub)]
        return i, j, est[i, j], np.arange(len(i)) >= len(i) - len(near)

    def of_twos(at: np.ndarray, sig: np.ndarray, size: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, ...]:
        est = (sig[at] == sig[at + 1]).mean(axis=1, dtype=np.float32)
        ok = (est >= least) & (root[at] != root[at + 1])
        ok &= np.minimum(size[at], size[at + 1]) >= ratio * np.maximum(size[at], size[at + 1])
        i, j, est = at[ok], at[ok] + 1, est[ok]
        if turn == 0:
            i, j, est = np.r_[i, j], np.r_[j, i], np.r_[est, est]
        return i, j, est, np.zeros(len(i), bool)

    def work(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        sig, size, root, own, _ = _columns(table)
        counts = np.diff(starts)
        found = [of_twos(starts[:-1][counts == 2], sig, size, root)]
        for lo, hi in zip(starts[:-1][counts > 2], starts[1:][counts > 2], strict=True):
            i, j, *rest = of_group(*(x[lo:hi] for x in (sig, size, root, own)))
            found.append((i + lo, j + lo, *rest))
        i, j, est, hub = (np.concatenate(x) for x in zip(*found, strict=True))
        a, b = (table.column("set_key").take(pa.array(x)).combine_chunks() for x in (i, j))
        for at in range(0, len(i), 100_000):
            part = [x[at : at + 100_000] for x in (a, b, pa.array(est.astype(np.float64)), pa.array(hub))]
            yield pa.RecordBatch.from_arrays(part, ["a", "b", "est", "hub"])

    found = by_group(members, "g", work, "a binary, b binary, est double, hub boolean")
    return found if turn == 0 else found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _involved(members: DataFrame, least: float, ratio: float) -> DataFrame:
    """``g, set_key, n, root``: the members that may be linked to another of their group, each candidate pair in one group.

    That is the first tree whose region holds both. Rows grow with the members
    of a tile, not with their pairs.
    """

    def met_before(i: np.ndarray, j: np.ndarray, sig: np.ndarray, tree: np.ndarray) -> np.ndarray:
        """Whether an earlier tree has the two in one region of the first level."""
        heads = sig[:, : TREES * DEPTH].reshape(len(sig), TREES, DEPTH)[:, :, : LEVELS[0]]
        earlier = np.arange(TREES) < tree[:, None]
        out = np.zeros(len(i), bool)
        for at in range(0, len(i), 50_000):
            a, b = i[at : at + 50_000], j[at : at + 50_000]
            out[at : at + 50_000] = ((heads[a] == heads[b]).all(axis=2) & earlier[a]).any(axis=1)
        return out

    def work(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        sig, size, root, own, tree = _columns(table)
        chosen = np.zeros(len(sig), bool)
        for lo, hi in zip(starts[:-1], starts[1:], strict=True):
            _, ok = _estimates(*(x[lo:hi] for x in (sig, size, root, own)), least, ratio)
            i, j = np.nonzero(np.triu(ok))
            fresh = ~met_before(i, j, sig[lo:hi], tree[lo:hi])
            chosen[lo + i[fresh]] = chosen[lo + j[fresh]] = True
        for batch in table.select(["g", "set_key", "n", "root"]).filter(pa.array(chosen)).to_batches():
            yield batch

    return by_group(members, "g", work, "g long, set_key binary, n long, root long")


def _linked(members: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links ``a, b`` between members of each group ``g`` by their full sets, one for each two roots that have any.

    The sets of a group are rows of a 0-1 matrix over the shingles that two or
    more of them hold; products of slices of it add up to all intersections.
    """

    def of_group(sets: list[np.ndarray], root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([len(x) for x in sets])
        owner = np.repeat(np.arange(len(sets)), size)
        names, at, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        place = np.where(often > 1, np.cumsum(often > 1) - 1, -1)[at]
        order = np.argsort(place, kind="stable")
        place, owner = place[order], owner[order]
        both = np.zeros((len(sets), len(sets)))
        for first in range(0, int(place[-1]) + 1, SHARED):
            lo, hi = np.searchsorted(place, [first, first + SHARED])
            part = np.zeros((len(sets), SHARED), np.float32)
            part[owner[lo:hi], place[lo:hi] - first] = 1
            both += part @ part.T
        joint = size[:, None] + size[None, :] - both
        i, j = np.nonzero(np.triu((100 * both >= percent * joint) & (root[:, None] != root[None, :]), 1))
        ends = np.stack([np.minimum(root[i], root[j]), np.maximum(root[i], root[j])], axis=1)
        one = np.unique(ends, axis=0, return_index=True)[1]
        return i[one], j[one]

    def work(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        root, found = table.column("root").to_numpy(), []
        for lo, hi in zip(starts[:-1], starts[1:], strict=True):
            texts = table.column("text").slice(lo, hi - lo).to_pylist()
            i, j = of_group([shingle_set(text, width) for text in texts], root[lo:hi])
            found.append((i + lo, j + lo))
        i, j = (np.concatenate(x) for x in zip(*found, strict=True))
        keys = table.column("set_key")
        ends = [keys.take(pa.array(x)).combine_chunks() for x in (i, j)]
        yield pa.RecordBatch.from_arrays(ends, ["a", "b"])

    held = members.join(docs, "set_key").select("g", "set_key", "root", "text")
    return by_group(held, "g", work, "a binary, b binary")


def _strongest(found: DataFrame) -> DataFrame:
    """Of all trees, the best partner and the best hub of each class, as pairs ``a < b``."""
    best = found.groupBy("a", "hub").agg(F.max(F.struct("est", "b")).alias("best")).select("a", F.col("best.b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets have ``100 * intersection >= percent * union``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, seen = [], {}
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for x, y, s, t in zip(a, b, batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                one = seen[x] if x in seen else seen.setdefault(x, shingle_set(s, width))
                two = seen[y] if y in seen else seen.setdefault(y, shingle_set(t, width))
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    a = docs.select(F.col("set_key").alias("a"), F.col("text").alias("text_a"))
    b = docs.select(F.col("set_key").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(run, "a binary, b binary")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 80
) -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_shingles, component_id, kept``.

    Documents are linked if ``100 * intersection >= percent * union`` of their
    sets of ``width``-word shingles; ``component_id`` is the smallest id that
    links reach, ``kept`` says that it is the own one. Null and empty texts
    have empty sets and link with nothing, not even with each other. Equal
    texts are linked; repeated rows give repeated results; rows with a null id
    count as texts and have the component of their group (null if all its ids
    are) and ``kept`` false. Other columns are not read. An empty table gives no rows.

    Candidates are found in three rounds. At first each class proposes its most
    similar partner in each region, and the hub of a region; what is confirmed
    joins components. Later rounds look only at pairs across components: some
    for members outside the main one, and in the last round all of those, on
    full sets and within the task that holds their blocks, so no
    link between components is missed for having been left out before and no
    pair that isn't linked leaves a task. In the
    first two rounds the blocks of a large region count as regions, so a class
    proposes as much there as in a small one; the last compares all blocks of
    all regions that share ``LEVELS[0]`` minima, whatever their size.
    """
    rows, named = _grouped(docs, id_col, text_col, width, percent)
    named = named.select("set_key", F.col("first.id").alias("component_id"))
    out = rows.where("set_key is not null").join(named, "set_key").select("id", "n_shingles", "component_id")
    empty = rows.where("set_key is null").select("id", "n_shingles", F.col("id").alias("component_id"))
    out = out.unionByName(empty)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", kept.alias("kept"))


def first_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 80
) -> DataFrame:
    """The rows of ``docs``, one of each component of near copies.

    Links are those of ``near_duplicates``. The row with the smallest id stays,
    null ids last; of several such rows the one whose text has the smallest
    hash, and of equal ids and texts the one with the smallest hash of all
    columns (maps aside). So one row stays of rows that occur twice, also where all ids are
    null, and an id that stays brings no other text of its own along. Texts
    without words link with nothing, and each row of them stays. A group limit
    before the shuffle leaves one row of equal ids and texts per task, so many
    copies are no single task.
    """
    _, named = _grouped(docs, id_col, text_col, width, percent)
    firsts = named.select("first.text_key", "first.copy_key").distinct()
    words = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keys = _keys(F.col(id_col), F.col(text_col))
    keyed = docs.where(words).select(F.struct(*docs.columns).alias("row"), *keys)
    content = F.xxhash64(*[F.col(f"row.`{c}`") for c, kind in docs.dtypes if "map<" not in kind])
    order = Window.partitionBy("text_key", "copy_key").orderBy(content)
    single = keyed.withColumn("place", F.row_number().over(order)).where("place = 1")
    return single.join(firsts, ["text_key", "copy_key"], "left_semi").select("row.*").union(docs.where(~words))


def _keys(id_: F.Column, text: F.Column) -> list[F.Column]:
    """Two hashes that together stand for an id and a text."""
    return [F.xxhash64(id_, text).alias("text_key"), F.xxhash64(F.lit(1), text, id_, id_.isNull()).alias("copy_key")]


def _grouped(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows with their sets, and of each ``set_key`` the ``first`` row of its component."""
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    base = base.select("*", *_keys(F.col("id"), F.col("text")))
    rows = materialise(_sets(base, width, kind), "sets")
    reps = rows.where("set_key is not null").groupBy("set_key").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key", "copy_key")).alias("first"),
        F.max("n_shingles").alias("n"), F.min("sig").alias("sig"), F.min("text_key").alias("text_key"),
    )
    reps = materialise(reps, "classes")
    low, ratio = percent / 100 - SLACK, percent / 100
    regions, early = _regions(reps)
    facts = reps.select("set_key", "n", "sig", F.xxhash64("set_key").alias("root"))
    proposed = materialise(_strongest(_candidates(_single(early).join(facts, "set_key"), low, ratio, 0)), "proposed")
    nodes = proposed.select(F.explode(F.array("a", "b")).alias("set_key"))
    nodes = materialise(nodes.union(regions.where("large").select("set_key")).distinct(), "nodes")
    regions, early = (x.join(nodes, "set_key", "left_semi") for x in (regions, early))
    wanted = reps.select("set_key", "text_key").join(nodes, "set_key", "left_semi")
    whole = materialise(base.join(wanted, "text_key").select("set_key", "text").distinct(), "texts")
    confirmed = materialise(_confirmed(proposed, whole, width, percent), "links")
    roots = components(confirmed)

    def state() -> DataFrame:
        known = roots.select(F.col("node").alias("set_key"), F.xxhash64("root").alias("known"))
        return facts.join(known, "set_key", "left").withColumn("root", F.coalesce("known", "root")).drop("known")

    near = _candidates(_single(early).join(state(), "set_key"), low, ratio, 1)
    found = materialise(near.join(proposed, ["a", "b"], "left_anti"), "proposed")
    if not found.isEmpty():
        confirmed = confirmed.union(materialise(_confirmed(found, whole, width, percent), "links"))
        roots = components(confirmed)
    involved = materialise(_involved(_tiles(regions.join(state(), "set_key")), low, ratio), "involved")
    if not involved.isEmpty():
        confirmed = confirmed.union(materialise(_linked(involved, whole, width, percent), "links"))
        roots = components(confirmed)
    named = reps.select("set_key", "first").join(roots.withColumnRenamed("node", "set_key"), "set_key", "left")
    named = materialise(named.withColumn("root", F.coalesce("root", "set_key")), "named")
    firsts = named.groupBy("root").agg(F.min("first").alias("first"))
    return rows, named.select("set_key", "root").join(firsts, "root").select("set_key", "first")
