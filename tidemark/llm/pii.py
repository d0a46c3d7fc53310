"""Personal data: fixed patterns, and a skip-chain conditional random field that makes labels consistent."""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts

KINDS = ("email", "ip", "card", "phone")
HELD = 50_000
"""Different looks of tokens that a task counts before it passes its sums on."""
ROUNDS = 12
"""Rounds of message passing."""
SURE = 0.9
"""Marginal at which a token becomes a span."""
LABELS = 1 + len(KINDS)
STEPS, RIDGE, BLOCK = 400, 1e-5, 50_000
"""Steps of the fit, its pull towards no weights, and looks that it takes at a time."""

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")  # begins where a word does, so a long word is read once

Span = tuple[int, int]


def _emails(text: str) -> Iterator[Span]:
    """Each @ with the longest local part before it and a dotted domain after it, from left to right."""
    end, at, before = 0, text.find("@"), -1
    while at >= 0:
        left = text[max(end, before + 1) : at]
        local = len(left) - len(left.rstrip(_LOCAL))
        before = at
        if at >= end and local and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield at - local, end
        at = text.find("@", max(at + 1, end))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _luhn(digits: str) -> bool:
    twice = [d - 9 if d > 9 else d for d in (2 * int(c) for c in digits[-2::-2])]
    return (sum(twice) + sum(map(int, digits[::-2]))) % 10 == 0


def base_spans(text: str) -> dict[str, list[Span]]:
    """Matches of the fixed patterns by kind; a match that fails its test is dropped and not tried again."""
    if not _SIGN.search(text):
        return {k: [] for k in KINDS}
    small = lambda part: len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255
    cards = [m.span() for m in _CARD.finditer(text) if 16 <= len(d := _digits(m[0])) <= 19 and _luhn(d)]
    return {
        "email": list(_emails(text)) if "@" in text else [],
        "ip": [m.span() for m in _IP.finditer(text) if all(map(small, m.groups()))],
        "card": cards,
        "phone": [m.span() for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15] if "+" in text else [],
    }


def _features(token: str) -> list[int]:
    """Indexes of what a token looks like, without its place."""
    digits = sum("0" <= c <= "9" for c in token)
    letters = sum(c.isalpha() for c in token)
    marks = len(token) - digits - letters
    return [
        0, 1 + min(digits, 20), 22 + min(letters, 20), 43 + min(marks, 8), 52 + min(token.count("."), 5), 58 + ("@" in token),
        60 + token.startswith("+"), 62 + ("(" in token), 64 + min(token.count("-"), 3), 68 + ("=" in token or '"' in token),
        70 + min(len(token), 40) // 4,
    ]


WIDTH = 81


@dataclass(frozen=True)
class Field:
    """Weights: ``unary`` by feature and label, ``chain`` and ``skip`` by pair of labels; label 0 is none."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def _tokens(text: str) -> list[tuple[int, int]]:
    """Tokens that could be personal data: with a digit or @, without marks at their ends."""
    found = []
    for m in _TOKEN.finditer(text):
        core = m[0].strip(".,;:!?\"'<>[]{}|#$&*")
        if core:
            start = m.start() + m[0].index(core)
            found.append((start, start + len(core)))
    return found


def _labels(tokens: list[Span], base: dict[str, list[Span]]) -> np.ndarray:
    """The kind of the pattern match that each token overlaps, 0 for none."""
    labels = np.zeros(len(tokens), int)
    starts = np.array([s for s, _ in tokens])
    ends = np.array([e for _, e in tokens])
    for k, kind in reversed(list(enumerate(KINDS, 1))):
        for s, e in base[kind]:
            labels[np.searchsorted(ends, s, "right") : np.searchsorted(starts, e, "left")] = k
    return labels


def _skips(words: list[str]) -> list[tuple[int, int]]:
    """Edges between distant tokens that are the same or alike, each to the last one before it.

    Alike are tokens with the same letters and digits, the same seven last
    digits, or the same name before an @. One edge for each key keeps the graph
    linear in the tokens however often one repeats.
    """
    last: dict[str, int] = {}
    edges = set()
    for i, word in enumerate(words):
        low = word.lower()
        plain, digits = "".join(c for c in low if c.isalnum()), _digits(low)
        keys = [f"w{plain}"] if len(plain) >= 5 else []
        if len(digits) >= 7:
            keys.append(f"d{digits[-7:]}")
        name = low.partition("@")[0]
        if len(name) >= 5:
            keys.append(f"n{name}")
        for key in keys:
            if key in last and last[key] != i:
                edges.add((last[key], i))
            last[key] = i
    return sorted(edges)


def _edges(text: str, tokens: list[Span]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    chain = [(i, i + 1) for i in range(len(tokens) - 1) if text[tokens[i][1] : tokens[i + 1][0]].strip(" ()") == "" and tokens[i + 1][0] - tokens[i][1] <= 3]
    return chain, _skips([text[s:e] for s, e in tokens])


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(field: Field, unary: np.ndarray, chain: list, skip: list) -> np.ndarray:
    """Label marginals by loopy belief propagation, all messages of a round at once, damped by half."""
    edges = np.array([*chain, *skip], int).reshape(-1, 2)
    weights = np.array([field.chain] * len(chain) + [field.skip] * len(skip)).reshape(-1, *field.chain.shape)
    a, b = np.r_[edges[:, 0], edges[:, 1]], np.r_[edges[:, 1], edges[:, 0]]
    weights = np.concatenate([weights, weights.transpose(0, 2, 1)])
    back = np.r_[np.arange(len(edges)) + len(edges), np.arange(len(edges))]
    sent = np.zeros((len(a), unary.shape[1]))
    belief = unary
    for _ in range(ROUNDS if len(a) else 0):
        new = _log_sum((belief[a] - sent[back])[:, :, None] + weights, 1)
        new -= _log_sum(new, 1)[:, None]
        sent = 0.5 * sent + 0.5 * new
        belief = unary.copy()
        np.add.at(belief, b, sent)
    return np.exp(belief - _log_sum(belief, 1)[:, None])


def added_spans(text: str, base: dict[str, list[Span]], field: Field) -> dict[str, list[Span]]:
    """Spans that the field finds beside the pattern matches, which it takes as given.

    Every text with a token that could be personal data is looked at, whether a
    pattern matches in it or not. A token becomes a span if its marginal for a
    kind reaches ``SURE``; what raises it are its look, its neighbours, and
    tokens like it elsewhere. Neighbouring tokens of a kind join.
    """
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    tokens = _tokens(text)
    labels = _labels(tokens, base)
    if labels.all():
        return out
    chain, skip = _edges(text, tokens)
    given = np.flatnonzero(labels)
    unary = np.stack([field.unary[_features(text[s:e])].sum(axis=0) for s, e in tokens])
    unary[given] = -50.0
    unary[given, labels[given]] = 0.0
    shares = marginals(field, unary, chain, skip)
    best = shares.argmax(axis=1)
    sure = (labels == 0) & (best > 0) & (shares.max(axis=1) >= SURE)
    order = np.flatnonzero(sure).tolist()
    joined = {i for i, _ in chain}
    i = 0
    while i < len(order):
        j = i
        while j + 1 < len(order) and order[j + 1] == order[j] + 1 and best[order[j + 1]] == best[order[i]] and order[j] in joined:
            j += 1
        out[KINDS[best[order[i]] - 1]].append((tokens[order[i]][0], tokens[order[j]][1]))
        i = j + 1
    return out


def _counts(docs: DataFrame, text_col: str) -> DataFrame:
    """``look, label, n``: tokens by their features and the labels of their neighbours.

    ``look`` holds the numbers of the features, then how many ``chain``
    neighbours have each label, then how many ``skip`` neighbours do. A token
    has two of the first and six of the second at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        for batch in batches:
            for text in texts(batch.column(0)):
                tokens = _tokens(text)
                found = _labels(tokens, base_spans(text)).tolist()
                around = [bytearray(2 * LABELS) for _ in tokens]
                for at, edges in zip((0, LABELS), _edges(text, tokens), strict=True):
                    for i, j in edges:
                        around[i][at + found[j]] += 1
                        around[j][at + found[i]] += 1
                rng = random.Random(xxhash.xxh3_64_intdigest(text))
                for (s, e), label, near in zip(tokens, found, around, strict=True):
                    if not label and any(near[LABELS + 1 :]):
                        continue  # like a match, so what it is stays open
                    word = text[s:e]
                    if label and rng.random() < 0.5:
                        cut = rng.randrange(len(word))
                        word = word[:cut] + word[cut + 1 :] if rng.random() < 0.7 else word.upper()
                    if word:
                        sums[bytes(_features(word)) + bytes(near), label] += 1
                if len(sums) >= HELD:
                    yield part(sums)
                    sums.clear()
        yield part(sums)

    def part(sums: Counter) -> pa.RecordBatch:
        looks, labels = zip(*sums, strict=True) if sums else ((), ())
        columns = [pa.array(looks, pa.binary()), pa.array(labels, pa.int32()), pa.array(list(sums.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["look", "label", "n"])

    distinct = docs.where(F.col(text_col).rlike("[0-9@]")).select(text_col).distinct()
    counted = distinct.mapInArrow(run, "look binary, label int, n long")
    return counted.groupBy("look", "label").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text_col: str = "text") -> Field:
    """Trains the field on all distinct texts with a digit or @, whole.

    The patterns label the tokens. All weights, those of looks, of neighbours and
    of skip edges, are fitted together to the pseudo-likelihood of the field:
    each token's label given the labels around it. Half of the labelled tokens
    are damaged as in careless writing (a mark or digit lost, other case), so
    that the field knows them without the pattern and learns how far to trust
    what is around them. A token without a label that is like one with a label
    takes no part: whether it is personal data is what the field is to tell. Tasks count tokens by look, label and labels around; only
    these sums reach the driver. Copies of a text count once, and the damage
    follows from the text, so neither order nor partitions matter.
    """
    seen: dict[bytes, np.ndarray] = {}
    for look, label, n in _counts(docs, text_col).toLocalIterator():
        seen.setdefault(bytes(look), np.zeros(LABELS))[label] += n
    weights = _pseudo_likelihood(*_design(seen)) if seen else np.zeros((WIDTH + 2 * LABELS, LABELS))
    chain, skip = weights[WIDTH : WIDTH + LABELS], weights[WIDTH + LABELS :]
    return Field(weights[:WIDTH], chain, skip)


def _design(seen: dict[bytes, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A row for each look in order: how often each weight counts; and its labels."""
    looks = sorted(seen)
    raw = np.frombuffer(b"".join(looks), np.uint8).reshape(len(looks), -1)
    design = np.zeros((len(looks), WIDTH + 2 * LABELS), np.uint8)
    for column in raw[:, : -2 * LABELS].T:
        design[np.arange(len(looks)), column] += 1
    design[:, WIDTH:] = raw[:, -2 * LABELS :]
    return design, np.array([seen[look] for look in looks])


def _pseudo_likelihood(design: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Weights by accelerated gradient ascent, with the step that the curvature allows; pair weights are symmetric."""
    total = counts.sum()
    parts = [(design[i : i + BLOCK], counts[i : i + BLOCK]) for i in range(0, len(design), BLOCK)]
    curved = sum((x.astype(float) * y.sum(axis=1, keepdims=True)).T @ x for x, y in parts) / total
    step = 2.0 / np.linalg.eigvalsh(curved)[-1]
    weights = ahead = np.zeros((design.shape[1], LABELS))
    for turn in range(STEPS):
        slope = -RIDGE * ahead
        for x, y in parts:
            score = x @ ahead
            share = np.exp(score - _log_sum(score, 1)[:, None])
            slope += x.T @ (y - y.sum(axis=1, keepdims=True) * share) / total
        moved = ahead + step * slope
        for pair in (moved[WIDTH : WIDTH + LABELS], moved[WIDTH + LABELS :]):
            pair[:] = (pair + pair.T) / 2
        ahead = moved + turn / (turn + 3) * (moved - weights)
        weights = moved
    return weights


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None) -> DataFrame:
    """``id_col, base, spans`` of every text: arrays of ``(kind, start, end)``, in code points, end exclusive.

    ``base`` holds the matches of the fixed patterns by kind (email, ip, card,
    phone) and start, ``spans`` these and what the field adds. Null, empty and
    clean texts have empty arrays; tokens that repeat very often cost one edge
    each; repeated rows give repeated results; other columns are not read; an
    empty table gives no rows. Matching is linear in the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field or fit(docs, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            bases, spans = [], []
            for text in texts(batch.column(1)):
                base = base_spans(text)
                more = added_spans(text, base, shared.value)
                bases.append([{"kind": k, "start": s, "end": e} for k in KINDS for s, e in base[k]])
                both = [(k, s, e) for k in KINDS for s, e in sorted([*base[k], *more[k]])]
                spans.append([{"kind": k, "start": s, "end": e} for k, s, e in both])
            made = [pa.array(bases, kind), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["id", "base", "spans"])

    entry = "array<struct<kind: string, start: bigint, end: bigint>>"
    found = docs.select(id_col, text_col).mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, base {entry}, spans {entry}")
    return found.withColumnRenamed("id", id_col)


def masked(text: str, field: Field) -> str:
    """The text with each span, overlapping ones as one, replaced by the kind in brackets."""
    base = base_spans(text)
    more = added_spans(text, base, field)
    spans = sorted((s, -e, k) for k in KINDS for s, e in [*base[k], *more[k]])
    out, at = [], 0
    for s, e, kind in spans:
        if s < at:
            if -e > at:
                at = -e
            continue
        out += [text[at:s], f"[{kind.upper()}]"]
        at = -e
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", field: Field | None = None) -> DataFrame:
    """``docs`` with personal data masked; ``length_col``, where there is one, follows the text. Nulls stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(field or fit(docs, text_col))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [None if t is None else masked(t, shared.value) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(clean, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    out = docs.mapInArrow(run, docs.schema)
    if length_col in docs.columns:
        size = F.char_length(text_col).cast(docs.schema[length_col].dataType)
        out = out.withColumn(length_col, F.coalesce(size, F.col(length_col)))
    return out
