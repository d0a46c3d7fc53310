"""The skip-chain field: marginals against enumeration, its joint fit, and what it adds to the patterns."""

import itertools
import random

import numpy as np
import pytest

from tidemark.llm import pii
from tidemark.llm.common import prepare


def _enumerated(field, unary, chain, skip):
    shares = np.zeros_like(unary)
    for labels in itertools.product(range(pii.LABELS), repeat=len(unary)):
        score = sum(unary[i, k] for i, k in enumerate(labels))
        score += sum(field.chain[labels[i], labels[j]] for i, j in chain) + sum(field.skip[labels[i], labels[j]] for i, j in skip)
        for i, k in enumerate(labels):
            shares[i, k] += np.exp(score)
    return shares / shares.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("chain, skip, near", [
    ([], [], 1e-9),
    ([(0, 1), (2, 3)], [(1, 2)], 5e-3),  # a tree: exact once the damped messages have settled
    ([(0, 1), (1, 2), (3, 4)], [(0, 3), (2, 4)], 0.08),  # a loop
    ([(0, 1)], [(0, 2), (1, 2), (2, 3), (3, 4), (0, 4)], 0.08),
])
def test_marginals_against_enumeration(chain, skip, near):
    rng = np.random.default_rng(7)
    for _ in range(3):
        pair = rng.normal(0, 0.6, (2, pii.LABELS, pii.LABELS))
        field = pii.Field(None, *((p + p.T) / 2 for p in pair))
        unary = rng.normal(0, 1, (5, pii.LABELS))
        assert np.abs(pii.marginals(field, unary, chain, skip) - _enumerated(field, unary, chain, skip)).max() < near


def test_the_fit_is_the_maximum_of_the_pseudo_likelihood():
    rng = np.random.default_rng(3)
    design = rng.integers(0, 2, (60, pii.WIDTH + 2 * pii.LABELS)).astype(np.uint8)
    counts = rng.integers(0, 5, (60, pii.LABELS)).astype(float)

    def value(weights):
        score = design @ weights
        top = score.max(axis=1, keepdims=True)
        logs = score - top - np.log(np.exp(score - top).sum(axis=1, keepdims=True))
        return (counts * logs).sum() / counts.sum() - pii.RIDGE / 2 * (weights**2).sum()

    best = pii._pseudo_likelihood(design, counts)
    chain, skip = best[pii.WIDTH : -pii.LABELS], best[-pii.LABELS :]
    assert np.allclose(chain, chain.T) and np.allclose(skip, skip.T)
    for _ in range(20):
        other = rng.normal(0, 0.3, best.shape)
        for pair in (other[pii.WIDTH : -pii.LABELS], other[-pii.LABELS :]):
            pair[:] = (pair + pair.T) / 2
        assert value(best) > value(best + other)


def _card(rng):
    digits = [4, *(rng.randrange(10) for _ in range(14))]
    twice = [d - 9 if d > 9 else d for d in (2 * d for d in digits[::2])]
    return "".join(map(str, [*digits, -(sum(twice) + sum(digits[1::2])) % 10]))


def test_careless_repeats_are_found_and_clean_documents_left_alone(spark):
    """Damaged repeats gain spans, also where no pattern matches; plain numbers gain none."""
    rng = random.Random(5)
    rows, damaged, clean = [], {}, set()
    for i in range(0, 900, 3):
        card, name = _card(rng), f"jo{i}.{rng.choice(['doe', 'lee', 'ray'])}"
        cut = rng.randrange(1, 8)
        wrong = card[:cut] + card[cut + 1 :]
        assert not pii.base_spans(wrong)["card"]
        rows += [
            (i, f"paid with {card} or {card} and wrote to {name}@mail.example.com about it"),
            (i + 1, f"paid with {card} first and then {wrong} was noted, ask {name}@mail.example.com again"),
            (i + 2, f"in {1900 + rng.randrange(120)} there were {rng.randrange(5000)} of them, {rng.randrange(99)} % more, on page {rng.randrange(400)}"),
        ]
        damaged[i + 1] = wrong
        clean.add(i + 2)
    alone = "noted 401288888888188 and later 401288888888188 again"
    assert not any(pii.base_spans(alone).values())
    rows += [(1000, alone), (1001, None), (1002, "")]
    texts = dict(rows)
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find(docs).collect()}
    assert all(r.base == r.spans == [] for r in found.values() if r.doc_id in clean or r.doc_id > 1000)
    added = {i: [texts[i][s.start : s.end] for s in r.spans if s not in r.base] for i, r in found.items()}
    assert sum(word in added[i] for i, word in damaged.items()) >= 0.9 * len(damaged)
    assert sum(len(x) for i, x in added.items() if i not in damaged and i < 1000) == 0
    assert added[1000] == ["401288888888188"] * 2
