"""How source rows become staging rows, as declarations."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.coerce import (
    Steps,
    add_typed,
    instant_steps,
    int_steps,
    text_steps,
    typed_names,
)
from tidemark.functions.hashing import derived_id, row_hash
from tidemark.sinks.quarantine import raw_json


@dataclass(frozen=True)
class Field:
    """``kind`` is int, text or timestamp, or a function of the source column and
    the field name that yields the steps of a custom coercion."""

    name: str
    source: str
    kind: str | Callable[[Column, str], Steps]
    fmt: str | None = None


@dataclass(frozen=True)
class Mapping:
    """Fields in the order that content hashes and error reports follow.

    ``default_parent`` replaces a missing parent id. With ``id_from`` a missing
    source id is derived from that time field and the parent id.
    """

    name: str
    fields: tuple[Field, ...]
    parent: str | None = None
    default_parent: int | None = None
    id_from: str | None = None


# Source columns and formats of each feed.
SUBJECT = Mapping(
    "subject",
    (Field("source_id", "id", "int"), Field("name", "name", "text"), Field("timezone", "timezone", "text")),
)
STATUS_DOCUMENT = Mapping(
    "status_document",
    (
        Field("source_id", "id", "int"),
        Field("change_time", "change_time", "timestamp"),
        Field("status", "status", "text"),
        Field("baby_id", "baby_id", "int"),
    ),
    parent="baby_id",
)
STATUS_TABLE = Mapping("status_table", STATUS_DOCUMENT.fields, parent="baby_id")
DURATION_TABLE = Mapping(
    "duration_table",
    (
        Field("source_id", "id", "int"),
        Field("sleep_start", "sleep_start", "timestamp"),
        Field("sleep_duration", "sleep_duration", "int"),
        Field("baby_id", "baby_id", "int"),
    ),
    parent="baby_id",
)
DURATION_DOCUMENT = Mapping(
    "duration_document",
    (
        Field("source_id", "id", "int"),
        Field("sleep_start", "start", "timestamp"),
        Field("sleep_duration", "duration", "int"),
        Field("baby_id", "baby_id", "int"),
    ),
    parent="baby_id",
)
AMOUNT_FILE = Mapping(
    "amount_file",
    (
        Field("source_id", "ID", "int"),
        Field("feed_time", "Time", "timestamp", "%d.%m.%Y, %H:%M"),
        Field("amount_ml", "Amount (ml)", "int"),
        Field("baby_id", "Baby ID", "int"),
    ),
    parent="baby_id",
    default_parent=1,
    id_from="feed_time",
)


def map_rows(df: DataFrame, mapping: Mapping, parent_id: Column | None = None) -> DataFrame:
    """Types every row: business columns, ``row_hash``, ``error_message`` and,
    for bad rows, ``raw``.

    Extra source columns are ignored and missing ones read NULL. The first
    field that cannot be typed gives the error; good rows have none. An
    explicit ``parent_id`` wins over the row's own.
    """
    coercions: list[Steps] = []
    for field in mapping.fields:
        if field.name == mapping.parent and parent_id is not None:
            continue
        present = field.source in df.columns
        source = F.col(f"`{field.source}`") if present else F.lit(None).cast("string")
        dtype = df.schema[field.source].dataType if present else None
        if field.kind == "timestamp":
            coercions.append(instant_steps(source, field.name, dtype, field.fmt))
        elif field.kind == "int":
            coercions.append(int_steps(source, field.name, dtype))
        elif isinstance(field.kind, str):
            coercions.append({"text": text_steps}[field.kind](source, field.name))
        else:
            coercions.append(field.kind(source, field.name))
    typed = add_typed(df, *coercions)

    names = {field.name: typed_names(field.name) for field in mapping.fields}
    values = {name: F.col(n.value) for name, n in names.items()}
    texts = {name: F.col(n.text) for name, n in names.items()}
    errors = [F.col(n.error) for n in names.values()]
    if mapping.parent and parent_id is not None:
        values[mapping.parent] = texts[mapping.parent] = parent_id.cast("int")
        errors = [F.col(n.error) for name, n in names.items() if name != mapping.parent]
    elif mapping.parent and mapping.default_parent is not None:
        parent = F.coalesce(values[mapping.parent], F.lit(mapping.default_parent))
        values[mapping.parent] = texts[mapping.parent] = parent
    if mapping.id_from:
        made = derived_id(texts[mapping.id_from], values[mapping.parent])
        key = mapping.fields[0].name
        values[key] = F.coalesce(values[key].cast("string"), made)
        typed = typed.withColumn("__id", values[key])
        values[key] = texts[key] = F.col("__id")

    error = F.coalesce(*errors)
    row = F.struct(
        *[v.alias(n) for n, v in values.items()],
        F.when(error.isNotNull(), raw_json(df.columns)).alias("raw"),
        error.alias("error_message"),
        row_hash(list(texts.values())).alias("row_hash"),
    )
    # A generator of one row. The optimizer does not move filters below it, so
    # the split on error_message tests a finished column instead of repeating
    # the whole typing inside a pushed-down filter.
    return typed.select(F.inline(F.array(row)))
