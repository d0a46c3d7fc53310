"""Repair of conversations: the cheapest edits that make the roles alternate, followed turn by turn."""

from __future__ import annotations

import hashlib
import os
import tempfile
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BATCH_ROWS

HELD = 8 << 20
"""Bytes that a conversation may hold in memory before its rows and back-pointers go to a file of the task."""

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
UNFINISHED = 3
"""Cost of a truncated row that stays."""

# States: nothing yet, after a system row, after a user row, after an assistant row
NONE, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
TURN = {NONE: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
"""The one user or assistant row that may follow each state."""
FINAL = (NONE, ASSISTANT)
NAME = {"u": "user", "a": "assistant"}
MOST_INSERTS = 2  # from any state, two lead back to it, or from a system row to an end

State = tuple[tuple[int, int] | None, ...]
"""By state, the cost above the cheapest and the place of its edits among those of the others, in ASCII order."""
START: State = ((0, 0), None, None, None)


def _inserted(state: int, count: int) -> int:
    for _ in range(count):
        state = TURN[state][1]
    return state


@lru_cache(maxsize=1 << 16)
def step(before: State, initial: str, faulty: bool, truncated: bool) -> tuple[State, int, tuple[tuple[int, str] | None, ...]]:
    """One row: the states after it, what the cheapest rose by, and where each state came from by which edits.

    Insertions come before the row they stand in front of. Of equal costs the
    edits least in ASCII win: those of the states before are in order, and no
    one of them begins another, since each ends with the edit of the last row.
    Costs are kept relative, so there are few different states and each is
    worked out once.
    """
    best: list[tuple[int, int, str, int] | None] = [None] * 4
    for state, entry in enumerate(before):
        if entry is None:
            continue
        for count in range(MOST_INSERTS + 1):
            at = _inserted(state, count)
            options = [(DELETE, at, 0)]
            if not faulty:
                stays = UNFINISHED if truncated else 0
                options.append((REROLE, TURN[at][1], stays))
                if (at, initial) in NEXT:
                    options.append((KEEP, NEXT[at, initial], stays))
            for edit, after, more in options:
                way = (entry[0] + COST[INSERT] * count + COST[edit] + more, entry[1], INSERT * count + edit, state)
                if best[after] is None or way < best[after]:
                    best[after] = way
    least = min(way[0] for way in best if way)
    order = sorted((way[1], way[2]) for way in best if way)
    after = tuple(way and (way[0] - least, order.index((way[1], way[2]))) for way in best)
    return after, least, tuple(way and (way[3], way[2]) for way in best)


def finish(states: State) -> tuple[int, int, str]:
    """State to end from, cost above the cheapest, and the insertions at the end."""
    ways = []
    for state, entry in enumerate(states):
        for count in range(MOST_INSERTS + 1) if entry else ():
            if _inserted(state, count) in FINAL:
                ways.append((entry[0] + COST[INSERT] * count, entry[1], INSERT * count, state))
    cost, _, edits, state = min(ways)
    return state, cost, edits


class _Conversation:
    """State of the conversation a task is in: a few numbers; rows and back-pointers up to ``HELD`` bytes, then files."""

    def __init__(self, key: str | None):
        self.key = key
        self.states, self.cost, self.rows = START, 0, 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None
        self.turns = 0
        self.initial: str | None = None
        self.before: tuple | None = None
        self.moves: list[tuple] = []
        self.known: dict[tuple, int] = {}
        self.back = array("I")
        self.texts = tempfile.SpooledTemporaryFile(HELD)
        self.spilled = None

    def add(self, turn: int | None, role: str, text: str, kind: str) -> None:
        if turn is not None:
            if turn != self.last:
                self.turns += 1
            self.first, self.last = (turn if self.first is None else self.first), turn
        initial = role[:1]
        if self.rows and (self.initial + initial) not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        if kind == "blank":
            self.blank += 1
        elif kind == "duplicate":
            self.duplicate += 1
        elif kind == "truncated":
            self.truncated += 1
        self.states, rise, move = step(self.states, initial, kind in ("blank", "duplicate"), kind == "truncated")
        self.cost += rise
        if move not in self.known:
            self.known[move] = len(self.moves)
            self.moves.append(move)
        self.back.append(self.known[move])
        self.rows += 1
        for part in (role, text):
            raw = part.encode()
            self.texts.write(len(raw).to_bytes(8, "little"))
            self.texts.write(raw)
        if len(self.back) * 4 >= HELD:
            if self.spilled is None:
                self.spilled = tempfile.TemporaryFile()
            self.back.tofile(self.spilled)
            self.back = array("I")

    def _backwards(self) -> Iterator[int]:
        yield from reversed(self.back)
        if self.spilled is not None:
            size = self.spilled.seek(0, os.SEEK_END)
            while size:
                take = min(size, HELD)
                size -= take
                self.spilled.seek(size)
                block = array("I")
                block.frombytes(self.spilled.read(take))
                yield from reversed(block)

    def result(self) -> tuple:
        state, rest, tail = finish(self.states)
        audit = bytearray(tail[::-1].encode())
        for at in self._backwards():
            state, edits = self.moves[at][state]
            audit += edits[::-1].encode()
        audit.reverse()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        row = (
            self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost + rest, audit.decode(),
            self._digest(audit),
        )
        self.texts.close()
        if self.spilled is not None:
            self.spilled.close()
        return row

    def _digest(self, audit: bytearray) -> str:
        """Hash of the repaired rows, which are read once more in order."""
        digest, state, rows = hashlib.sha256(), NONE, 0
        self.texts.seek(0)

        def part() -> bytes:
            return self.texts.read(int.from_bytes(self.texts.read(8), "little"))

        for code in audit:
            edit = chr(code)
            role, text = (b"", b"") if edit == INSERT else (part(), part())
            if edit == DELETE:
                continue
            if edit == KEEP:
                state = NEXT[state, role.decode()[:1]]
            else:
                letter, state = TURN[state]
                role = NAME[letter].encode()
            digest.update((b"\n" if rows else b"") + role + b":" + text)
            rows += 1
        return digest.hexdigest()


RESULT = (
    "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


def _follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order of conversation and turn to one row a conversation."""
    names = [field.split()[0] for field in RESULT.split(", ")]
    now, done = None, []
    for batch in batches:
        for key, turn, role, text, kind, copies, again in zip(*(batch[c].array for c in ROW), strict=True):
            key = None if pd.isna(key) else key
            if now is None or key != now.key:
                if now is not None:
                    done.append(now.result())
                now = _Conversation(key)
            turn = None if pd.isna(turn) else int(turn)
            for _ in range(copies):
                here = (turn, role, text)
                seen = again or here == now.before
                now.add(turn, role, text, "duplicate" if seen and kind != "blank" else kind)
                now.before = here
        if len(done) >= BATCH_ROWS:
            yield pd.DataFrame(done, columns=names)
            done = []
    if now is not None:
        done.append(now.result())
    yield pd.DataFrame(done, columns=names)


ROW = ["conv", "turn_no", "role", "text", "kind", "copies", "again"]


def damaged(talks: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, turn_no, role, text, copies``: each row damaged by the checksum of conversation and turn, modulo 20.

    0 drops it (no copies), 1 empties the text, 2 takes its full stops,
    exclamation and question marks, 3 repeats it, 4 makes it the user's. Nulls
    stand for one space in all of these, and a row without a turn has none.
    """
    space = F.lit(" ")

    def plain(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), space)

    code = F.crc32(F.concat(plain(conv_col), F.lit(":"), plain(turn_col))) % 20
    rows = talks.select(
        F.col(f"`{conv_col}`").cast("string").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn_no"),
        plain(role_col).alias("role"), plain(text_col).alias("text"), code.alias("code"),
    )
    text = F.when(F.col("code").isin(0, 1), "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", ""))
    return rows.select(
        "conv", "turn_no", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.when(F.col("code") == 0, 0).when(F.col("code") == 3, 2).otherwise(1).alias("copies"),
    )


def judged(rows: DataFrame) -> DataFrame:
    """Adds ``kind`` (blank, truncated or whole) and ``again``: an earlier turn of the conversation has role and text.

    The first turn of each text comes from an aggregate with partial sums, and
    only texts that stand in several turns are joined back, so a text that is
    said over and over neither meets itself nor is gathered. Copies within a
    turn are neighbours in the order and are left to the caller.
    """
    last = F.right(F.rtrim("text", F.lit(" \t\n\x0b\f\r")), F.lit(1))
    kind = F.when(last == "", "blank").when(~last.isin(".", "!", "?"), "truncated").otherwise("whole")
    keyed = rows.withColumns({"kind": kind, "said": F.sha2(F.concat_ws("\n", F.length("role").cast("string"), "role", "text"), 256)})
    turn = F.coalesce("turn_no", F.lit(-(1 << 63)))  # no turn comes first
    first = (
        keyed.where("copies > 0").groupBy("conv", "said").agg(F.min(turn).alias("first"), F.max(turn).alias("final"))
        .where("first < final").select(F.col("conv").alias("in_conv"), F.col("said").alias("as_said"), "first")
    )
    met = F.col("conv").eqNullSafe(F.col("in_conv")) & (F.col("said") == F.col("as_said"))
    again = F.coalesce(turn > F.col("first"), F.lit(False))
    return keyed.join(first, met, "left").withColumn("again", again).select(*ROW)


def repair(rows: DataFrame) -> DataFrame:
    """The cheapest repair of every conversation of ``rows`` (see ``damaged``), as a row of ``RESULT``.

    Rows are dealt by conversation and sorted by turn (none first, then role
    and text); a task streams them. It carries costs by state across batches,
    and rows and back-pointers (four bytes a row) in memory up to ``HELD``,
    then in a file of its own, which no one else reads: a task that is lost
    starts over from the shuffle. A giant conversation thus costs time in one
    task, since its hash runs over the repaired rows in order, but no memory
    beyond its audit.

    A row whose role is empty or starts with no role's letter can't be kept as
    it is. A conversation without rows left has zeros, an empty audit and the
    hash of nothing.
    """
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn_no"), "role", "text"]
    dealt = judged(rows).repartition(F.col("conv")).sortWithinPartitions(*order)
    dealt = dealt.withColumn("turn_no", F.col("turn_no").cast("string"))  # pandas has no null whole numbers
    return dealt.mapInPandas(_follow, RESULT)


def repair_damaged(talks: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_col`` and its repair (``RESULT``) for every conversation of ``talks``, rows damaged first.

    Nulls: see ``damaged``; rows without a conversation are one conversation.
    Rows of one turn are ordered by role and text, equal ones are each other's
    duplicates. Other columns aren't read; no rows give none.
    """
    kind = talks.schema[conv_col].dataType
    fixed = repair(damaged(talks, conv_col, turn_col, role_col, text_col))
    return fixed.withColumn("conv", F.col("conv").cast(kind)).withColumnRenamed("conv", conv_col)
