"""Content hashes and derived identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def row_hash(parts: Sequence[Column]) -> Column:
    """SHA-256 over the business fields joined by ``|``; NULL reads ``None``."""
    texts = [F.coalesce(p.cast("string"), F.lit("None")) for p in parts]
    return F.sha2(F.concat_ws("|", *texts), 256)


def derived_id(time_text: Column, parent_id: Column) -> Column:
    """Sixteen hex digits that identify an event lacking an id of its own.

    ``time_text`` is the ``yyyy-MM-dd HH:mm:ss`` rendering of the event time.
    """
    iso = F.regexp_replace(time_text, " ", "T")
    seed = F.concat_ws(
        "|", F.coalesce(iso, F.lit("None")), F.coalesce(parent_id.cast("string"), F.lit("None"))
    )
    return F.substring(F.sha2(seed, 256), 1, 16)
