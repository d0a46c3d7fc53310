"""Repair of conversations against an exhaustive search for the cheapest edits."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.llm import dialogue
from tidemark.llm.common import prepare

LEGAL = re.compile(r"(s?(ua)+)?")
NAMES = {"u": "user", "a": "assistant"}


def _damaged(rows):
    """conversation -> (turn, role, text) after damage, in order"""
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        here = out.setdefault(conv, [])
        place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(place.encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        here += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    for here in out.values():
        here.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def _faults(rows):
    seen, kinds = set(), []
    for _, role, text in rows:
        letters = re.findall(r"[^\x20\x09-\x0D]", text)
        if not letters:
            kinds.append("blank")
        elif (role, text) in seen:
            kinds.append("duplicate")
        else:
            kinds.append("whole" if letters[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return kinds


def _search(rows, kinds):
    """All edit sequences with at most two insertions in a place."""
    inserts = [""] + ["".join(p) for n in (1, 2) for p in itertools.product("ua", repeat=n)]
    choices = []
    for (_, role, text), kind in zip(rows, kinds, strict=True):
        more = 3 if kind == "truncated" else 0
        options = [("D", 4, "", None)]
        if kind not in ("blank", "duplicate"):
            options += [("R", 3 + more, x, f"{NAMES[x]}:{text}") for x in "ua"]
            if role:
                options.append(("K", more, role[0], f"{role}:{text}"))
        choices.append(options)
    best = None
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        for edits in itertools.product(*choices):
            letters = gaps[0] + "".join(e[2] + g for e, g in zip(edits, gaps[1:], strict=True))
            if not LEGAL.fullmatch(letters):
                continue
            cost = sum(e[1] for e in edits) + 3 * sum(map(len, gaps))
            audit = "I" * len(gaps[0]) + "".join(e[0] + "I" * len(g) for e, g in zip(edits, gaps[1:], strict=True))
            if best is None or (cost, audit) < best[:2]:
                made = [f"{NAMES[x]}:" for x in gaps[0]]
                for e, g in zip(edits, gaps[1:], strict=True):
                    made += [e[3]] * (e[3] is not None) + [f"{NAMES[x]}:" for x in g]
                best = cost, audit, "\n".join(made)
    return best


def _expected(rows):
    out = []
    for conv, here in _damaged(rows).items():
        kinds = _faults(here)
        turns = [t for t, _, _ in here if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        first = [role[:1] for _, role, _ in here]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(first))
        cost, audit, text = _search(here, kinds)
        counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


SCHEMA = "conv_id long, turn long, role string, text string, kind string, copies int, code int, said string"


def _frame(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(*r, "k", 1, 2, "s") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    """Conversations of up to three rows, odd in every column."""
    rng = random.Random(3)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]
    texts = ["Yes.", "No", "Why?", "", " \n", None, "Go!", "a.b", "Ünd。", "end. ", "end. \t\r\n"]
    made = []
    for conv in range(60):
        for k in range(rng.randint(1, 3)):
            turn = None if rng.random() < 0.1 else k + rng.choice([0, 0, 0, 1, 5])
            made.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    made += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Hello."), (2**62, 2**60, "user", "Far.")]
    made += [(100 + c, t, "user" if t % 2 else "assistant", "Same.") for c in range(5) for t in range(2)]
    return [r for r in made if len(_damaged([r])) == 1]


def test_rows_equal_the_search(spark, rows):
    damaged = _damaged(rows)
    small = [r for r in rows if len(damaged[r[0]]) <= 3]
    got = dialogue.repair_damaged(_frame(spark, small))
    assert got.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == _expected(small)


def test_repeated_rows_and_texts(spark):
    """A text in several turns, a row that stands there several times, copies by damage."""
    rows = [(c, t, "user", "Again.") for c in (1, 2) for t in range(30)] + [(3, 4, "user", "Yes.")] * 40
    got = {r.conv_id: r for r in dialogue.repair_damaged(_frame(spark, rows)).collect()}
    for conv, here in _damaged(rows).items():
        kinds = Counter(_faults(here))
        assert (got[conv].duplicate, got[conv].blank) == (kinds["duplicate"], kinds["blank"])
        assert len(got[conv].audit.replace("I", "")) == len(here)


def test_conversation_without_rows_left(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = dialogue.repair_damaged(_frame(spark, [(gone, 0, "user", "Hi.")])).collect()
    assert [tuple(r) for r in row] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_no_rows(spark):
    assert dialogue.repair_damaged(_frame(spark, [])).count() == 0


def _stream(rows, size):
    frame = pd.DataFrame(rows, columns=dialogue.ROW)
    parts = [frame.iloc[i : i + size] for i in range(0, len(frame), size)]
    return pd.concat(list(dialogue._follow(iter(parts)))).values.tolist()


def test_state_crosses_batches_and_files(monkeypatch):
    rng = random.Random(11)
    kinds = ["whole", "whole", "truncated", "blank", "duplicate"]
    rows = [
        (conv, str(t), rng.choice(["user", "assistant", "system"]), f"text {t}" + "é" * rng.randint(0, 50), rng.choice(kinds), 1, False)
        for conv, n in (("a", 5000), ("b", 3), ("c", 900)) for t in range(n)
    ]
    whole = _stream(rows, 10_000)
    assert whole == _stream(rows, 7)
    monkeypatch.setattr(dialogue, "HELD", 512)  # back-pointers and texts go to files
    assert whole == _stream(rows, 64)
    assert [len(re.sub("I", "", r[7])) for r in whole] == [5000, 3, 900]


def test_hot_conversation_equals_sql_free_dynamic_program(spark):
    """A third of all rows in one conversation; compared with a plain table of costs by row and state."""
    rng = random.Random(5)
    roles = ["user", "assistant", "system"]
    rows = [(7, t, rng.choice(roles), f"No. {t % 1500}" + rng.choice([".", "", "?"])) for t in range(3000)]
    rows += [(100 + c, t, roles[t % 2], "Fine.") for c in range(1000) for t in range(3)]
    got = dialogue.repair_damaged(_frame(spark, rows)).where(F.col("conv_id") == 7).first()
    here = _damaged([r for r in rows if r[0] == 7])[7]
    kinds = _faults(here)
    table = {0: (0, "")}
    for (_, role, _), kind in zip(here, kinds, strict=True):
        after = {}
        for state, (cost, audit) in table.items():
            for n in range(3):
                at = state
                for _ in range(n):
                    at = 3 if at == 2 else 2
                more = 3 if kind == "truncated" else 0
                ways = [("D", 4, at)]
                if kind not in ("blank", "duplicate"):
                    ways.append(("R", 3 + more, 3 if at == 2 else 2))
                    to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((at, role[0]))
                    if to:
                        ways.append(("K", more, to))
                for edit, price, to in ways:
                    way = (cost + 3 * n + price, audit + "I" * n + edit)
                    after[to] = min(after.get(to, way), way)
        table = after
    ends = [(c, a) for s, (c, a) in table.items() if s in (0, 3)]
    ends += [(c + 3, a + "I") for s, (c, a) in table.items() if s == 2]
    ends += [(c + 6, a + "II") for s, (c, a) in table.items() if s in (1, 3)]
    assert (got.cost, got.audit) == min(ends)
    assert got.duplicate == kinds.count("duplicate") and got.truncated == kinds.count("truncated")
