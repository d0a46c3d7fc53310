"""Bit-set filters of the keys in each partition of a table, kept beside it.

Insert-if-absent asks for each key of a batch whether the table has it, and
mostly it hasn't. A filter answers that from a few bits a key: "surely not", or
"perhaps, in the batches of these runs". Only keys of the second kind are joined
with the table, and only partitions that may hold one are read. The filter
never misses a key, so the rows are those of the plain join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.operators.dedup import first_per_key
from tidemark.session import materialise

BITS = 1 << 15
"""Bits of a block, those of one built-in bitmap."""
PROBES = 4
"""Bits that a key sets in its block."""


@dataclass(frozen=True)
class KeyFilter:
    """Filters of ``key`` in a table with directories by ``lead`` and then ``run``.

    ``lead`` (a month) follows from the key; ``run`` names the batch. A
    partition has ``blocks`` blocks of 4 KB at most. With one block for each 2048
    keys about 3 keys in 1000 are wrongly thought present; fuller blocks cost
    exact joins, not rows.
    """

    key: tuple[str, ...]
    blocks: int
    lead: str = "month_sk"
    run: str = "job_id"

    @property
    def schema(self) -> T.StructType:
        whole = T.IntegerType()
        fields = {self.lead: whole, self.run: whole, "blocks": whole, "block": whole, "bits": T.BinaryType()}
        return T.StructType([T.StructField(n, t) for n, t in fields.items()])

    def _block(self) -> Column:
        return F.pmod(F.xxhash64(F.lit(0), *self.key), F.lit(self.blocks)).cast("int")

    def _places(self) -> list[Column]:
        mixed = F.xxhash64(F.lit(1), *self.key)
        return [F.shiftrightunsigned(mixed, 15 * i).bitwiseAND(F.lit(BITS - 1)) for i in range(PROBES)]

    def build(self, rows: DataFrame) -> DataFrame:
        """The filters of the partitions that ``rows`` fill: a bitmap for each block, with partial sums."""
        marks = rows.select(self.lead, self.run, self._block().alias("block"), F.explode(F.array(*self._places())).alias("place"))
        bits = marks.groupBy(self.lead, self.run, "block").agg(F.bitmap_construct_agg("place").alias("bits"))
        return bits.withColumn("blocks", F.lit(self.blocks)).select(self.schema.fieldNames())

    def runs_that_may_hold(self, rows: DataFrame, filters: DataFrame, name: str) -> DataFrame:
        """``rows`` with an array ``name`` of the runs whose partition of the row's ``lead`` may hold its key."""
        of_block = filters.groupBy(F.col(self.lead).alias("_lead"), F.col("block").alias("_block")).agg(
            F.collect_list(F.struct(F.col(self.run).alias("run"), "bits")).alias("_sets")
        )
        probed = rows.withColumns({f"_place{i}": p for i, p in enumerate(self._places())} | {"_at": self._block()})
        joined = probed.join(of_block, (F.col(self.lead) == F.col("_lead")) & (F.col("_at") == F.col("_block")), "left")
        set_ = lambda bits: reduce(and_, [_bit(bits, F.col(f"_place{i}")) for i in range(PROBES)])
        hits = F.transform(F.filter("_sets", lambda s: set_(s["bits"])), lambda s: s["run"])
        return joined.select(*rows.columns, F.coalesce(hits, F.array().cast("array<int>")).alias(name))


def _bit(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1


def absent_by_filter(
    batch: DataFrame, target: DataFrame, stored: Sequence[tuple[int, int]], filters: DataFrame, by: KeyFilter,
    order: Sequence[Column],
) -> DataFrame:
    """``absent_rows`` that reads only partitions of ``target`` that may hold keys of the batch.

    ``batch`` has the column ``by.lead``. ``stored`` lists the partitions of the
    target (lead, run); those that have no filter of this shape are read
    whenever the batch has keys of their lead. Keys with nulls are absent, as
    in a join.
    """
    known = filters.where(F.col("blocks") == by.blocks)
    winners = first_per_key(batch, list(by.key), order)
    probed = materialise(by.runs_that_may_hold(winners, known, "_runs"), "probed")
    touched = {r[0] for r in probed.select(by.lead).where(F.col(by.lead).isNotNull()).distinct().collect()}
    has_filter = {tuple(r) for r in known.where(F.col(by.lead).isin(list(touched))).select(by.lead, by.run).distinct().collect()}
    blind = {p for p in stored if p[0] in touched and p not in has_filter}
    hit = {tuple(r) for r in probed.select(by.lead, F.explode("_runs")).distinct().collect()}
    runs: dict[int, list[int]] = {}
    for lead, run in sorted(blind | hit):
        runs.setdefault(lead, []).append(run)
    opened = target.where(reduce(or_, [(F.col(by.lead) == m) & F.col(by.run).isin(r) for m, r in runs.items()], F.lit(False)))
    asked = (F.size("_runs") > 0) | F.coalesce(F.col(by.lead).isin([m for m, _ in blind]), F.lit(False))
    sure, maybe = (probed.where(x).drop("_runs") for x in (~asked, asked))
    present = opened.select(*by.key).join(maybe.select(*by.key), list(by.key), "left_semi")
    return sure.unionByName(maybe.join(present, list(by.key), "left_anti"))
