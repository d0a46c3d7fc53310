"""License notices in texts: MinHash bands over windows retrieve templates, containment confirms them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tidemark.llm.common import texts
from tidemark.llm.minhash import _mix

WIDTH = 5
BANDS, ROWS = 64, 2
"""A window and a template of similarity 0.5 share a band but for a chance of 1e-8."""

# fixed values: public license notices
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "mit": "Released under the MIT License.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

_WORD = re.compile(r"[^\W_]+")
_SEEDS = np.random.Generator(np.random.PCG64(5)).integers(0, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64)


def words_of(text: str) -> list[str]:
    """Runs of letters and digits, in lower case."""
    return _WORD.findall(text.lower())


def _shingles(words: list[str]) -> np.ndarray:
    """A hash of each run of ``WIDTH`` words, in order; fewer words are one run."""
    n = max(1, len(words) - WIDTH + 1) if words else 0
    return np.array([xxhash.xxh64_intdigest(" ".join(words[i : i + WIDTH])) for i in range(n)], np.uint64)


def _bands(shingles: np.ndarray) -> list[bytes]:
    low = (shingles[:, None] * (_SEEDS[0] | np.uint64(1)) + _SEEDS[1])
    low = _mix(low).min(axis=0)
    return [i.to_bytes(2, "little") + low[i * ROWS : (i + 1) * ROWS].tobytes() for i in range(BANDS)]


@dataclass(frozen=True)
class Templates:
    """Templates by name, their shingles, the bands that retrieve them, and their words."""

    names: list[str]
    shingles: list[np.ndarray]
    sizes: list[int]
    bands: list[dict[bytes, list[int]]]
    vocabulary: frozenset[str]

    @staticmethod
    def of(notices: dict[str, str]) -> Templates:
        named = {n: words_of(t) for n, t in sorted(notices.items()) if words_of(t)}
        names = list(named)
        runs = [_shingles(named[n]) for n in names]
        shingles = [np.unique(x) for x in runs]
        sizes = sorted({len(x) for x in runs})
        bands: list[dict[bytes, list[int]]] = [{} for _ in sizes]
        for i, x in enumerate(runs):
            for band in _bands(shingles[i]):
                bands[sizes.index(len(x))].setdefault(band, []).append(i)
        return Templates(names, shingles, sizes, bands, frozenset(w for x in named.values() for w in x))


def matches(text: str, known: Templates, least: float) -> dict[str, float]:
    """Templates that a window of the text contains to at least ``least``, with the highest containment.

    For each size of template, windows half as long again follow each other at
    a quarter of that size, so an undamaged notice lies whole in one of them. A
    run with a word that no template has is a shingle of its own that none can
    contain; windows without any other are passed over.
    """
    words = words_of(text)
    inside = np.fromiter((w in known.vocabulary for w in words), bool, len(words))
    found: dict[str, float] = {}
    n = len(words) - WIDTH + 1
    short = n < 1
    if not len(words) or not inside.any():
        return found
    if short:
        possible = np.array([inside.all()])
    else:
        total = np.r_[0, inside.cumsum()]
        possible = total[WIDTH:] - total[:-WIDTH] == WIDTH
    if not possible.any():
        return found
    reach = np.r_[0, possible.cumsum()]
    hashes: dict[int, int] = {}
    for size, bands in zip(known.sizes, known.bands, strict=True):
        span, stride = size + size // 2, max(1, size // 4)
        at = np.arange(0, max(1, len(possible) - span + stride), stride)
        full = reach[np.minimum(at + span, len(possible))] - reach[at]
        for lo in at[full >= least * size * 0.5]:
            run = range(lo, min(lo + span, len(possible)))
            for i in run:
                if i not in hashes:
                    hashes[i] = xxhash.xxh64_intdigest(" ".join(words[i : i + WIDTH]))
            window = np.unique(np.array([hashes[i] for i in run], np.uint64))
            near = {t for band in _bands(window) for t in bands.get(band, ())}
            for t in near:
                share = np.isin(known.shingles[t], window, assume_unique=True).mean()
                if share >= least:
                    name = known.names[t]
                    found[name] = max(found.get(name, 0.0), float(share))
    return found


def scan(docs: DataFrame, notices: dict[str, str] | None = None, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, licenses, containment`` for every row of ``docs``: names in order and their containment.

    A template is found if ``least`` of its distinct five-word shingles stand
    in one window of the text. The templates are a parameter and go to every
    task; texts are read whole in one pass without a shuffle. Null, empty and
    clean texts have empty arrays; a text of fewer than five words is one
    shingle; repeated rows give repeated results; other columns are not read;
    an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Templates.of(TEMPLATES if notices is None else notices))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(matches(t, shared.value, least).items()) for t in texts(batch.column(1))]
            names = pa.array([[n for n, _ in x] for x in found], pa.list_(pa.string()))
            shares = pa.array([[s for _, s in x] for x in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), names, shares], ["id", "licenses", "containment"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, licenses array<string>, containment array<double>")
    return out.withColumnRenamed("id", id_col)
