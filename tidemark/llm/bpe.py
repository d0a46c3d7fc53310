"""Byte-level BPE: encoding of whole texts with a rank file and decoding of ids to bytes."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from tidemark.llm.common import texts

CHUNK = 1 << 16
"""Characters that one call to the tokenizer gets, if the text has safe boundaries."""

_BOUNDARY = re.compile(r"(?<=[A-Za-z0-9.,;:!?])(?=[ \n])|(?<=[A-Za-z])(?=[0-9.,;:!?])|(?<=[0-9])(?=[A-Za-z.,;:!?])")


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, read once in each worker; no special tokens."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def _matcher(pattern: str) -> regex.Pattern:
    """The pattern for Python, with the Unicode property White_Space for white space."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def safe_pieces(text: str, chunk: int = CHUNK) -> Iterator[str]:
    """Cuts a long text where every match of the pattern must end.

    No match holds a character that is not white space followed by white
    space, a letter followed by a digit or mark, or a digit followed by a
    letter or mark; and nothing in the pattern looks back. So the pieces give
    the same matches as the whole. ASCII neighbours only, whose classes agree
    everywhere. A stretch without such a place stays whole.
    """
    start = 0
    while len(text) - start > chunk:
        cut = _BOUNDARY.search(text, start + chunk)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(enc: tiktoken.Encoding, text: str, chunk: int = CHUNK) -> np.ndarray:
    """The ids of a whole text as unsigned 32-bit integers.

    A piece far beyond ``chunk`` has no safe boundary (one run of white space,
    say) and would overflow the stack of the library's matcher; its matches
    are found here and encoded one by one.
    """
    found = []
    for piece in [text] if len(text) <= chunk else safe_pieces(text, chunk):
        if len(piece) > 2 * chunk:
            single = enc._encode_single_piece
            ids = [i for m in _matcher(enc._pat_str).finditer(piece) for i in single(m[0])]
            found.append(np.array(ids, dtype="<u4"))
        else:
            found.append(np.array(enc._core_bpe.encode_ordinary(piece), dtype="<u4"))
    return found[0] if len(found) == 1 else np.concatenate(found)


def encode_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every text and decodes the ids again: ``id_col, ids, decoded``.

    ``ids`` is a binary of little-endian unsigned 32-bit ids, ``decoded`` the
    bytes they stand for, equal to the UTF-8 of the text. Null and empty texts
    give empty binaries; repeated rows give repeated results; other columns
    are not read. One pass, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for batch in batches:
            ids = [encode(enc, t) for t in texts(batch.column(1))]
            raw = pa.array([i.tobytes() for i in ids], pa.binary())
            back = pa.array([enc._core_bpe.decode_bytes(i.tolist()) for i in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), raw, back], ["id", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, ids binary, decoded binary")
    return out.withColumnRenamed("id", id_col)


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
