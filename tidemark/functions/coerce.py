"""Typing of raw text. Every coercion yields a value, an error and a text column.

All expressions are built-in functions, so a mapping of many fields stays in a
single generated stage. Nothing raises at run time: a value that cannot be
typed becomes NULL with an error text, which sends its row to quarantine.

A coercion is a list of steps, each naming columns that later steps refer to.
``add_typed`` turns the steps into stacked projections. That way the text of a
field is cleaned once per row, where one nested expression would repeat the
cleaning in every branch.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import zip_longest

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The characters counted as white space around a field.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

# The timestamp formats tried, in order, after the caller's own.
TIMESTAMP_FORMATS = (
    "%Y-%m-%dT%H:%M:%S%z",
    "%Y-%m-%dT%H:%M%z",
    "%Y-%m-%d %H:%M",
    "%Y-%m-%d %H:%M:%S",
    "%Y-%m-%dT%H:%M",
    "%Y-%m-%dT%H:%M:%S",
    "%d.%m.%Y, %H:%M",
    "%d.%m.%Y %H:%M",
    "%d/%m/%Y %H:%M",
    "%m/%d/%Y %H:%M",
)

# directive -> (Spark datetime pattern, regular expression of its text)
_DIRECTIVES = {
    "%Y": ("yyyy", r"\d{4}"),
    "%m": ("M", r"\d{1,2}"),
    "%d": ("d", r"\d{1,2}"),
    "%H": ("H", r"\d{1,2}"),
    "%M": ("m", r"\d{1,2}"),
    "%S": ("s", r"\d{1,2}"),
}
_ZONE = r"(?:Z|[+-]\d{2}:?[0-5]\d)"


def clean_text(col: Column) -> Column:
    """Text without surrounding white space; blank becomes NULL."""
    return F.nullif(F.btrim(col.cast("string"), F.lit(WHITESPACE)), F.lit(""))


def clean_status(col: Column) -> Column:
    return F.lower(F.btrim(col.cast("string"), F.lit(WHITESPACE)))


@dataclass(frozen=True)
class Typed:
    """Names of the columns a coercion adds.

    ``value`` is the typed value, ``error`` the reason where there is none, and
    ``text`` the value as content hashes see it.
    """

    value: str
    error: str
    text: str


Steps = list[dict[str, Column]]


def typed_names(name: str) -> Typed:
    return Typed(f"__{name}_value", f"__{name}_error", f"__{name}_text")


def add_typed(df: DataFrame, *coercions: Steps) -> DataFrame:
    """Adds the columns of several coercions, one projection per level of steps."""
    for level in zip_longest(*coercions, fillvalue={}):
        df = df.withColumns({name: col for step in level for name, col in step.items()})
    return df


def _failed(text: Column, target: str) -> Column:
    return F.concat(F.lit("Cannot convert '"), text, F.lit(f"' to {target}"))


def text_steps(source: Column, name: str) -> Steps:
    out = typed_names(name)
    return [
        {out.value: clean_text(source)},
        {out.error: F.lit(None).cast("string"), out.text: F.col(out.value)},
    ]


def int_steps(source: Column, name: str, dtype: T.DataType | None = None) -> Steps:
    """32-bit integer >= 0. Blank is NULL; digits with or without a sign are accepted.

    Columns that already hold whole numbers need no cleaning or parsing.
    """
    out, text, number = typed_names(name), F.col(f"__{name}_clean"), F.col(f"__{name}_number")
    negative = (number < 0) | text.rlike("^-[0-9]+$")
    whole = isinstance(dtype, T.IntegralType)
    return [
        {f"__{name}_clean": source.cast("string") if whole else clean_text(source)},
        {f"__{name}_number": source.try_cast("int") if whole else text.try_cast("int")},
        {
            out.value: F.when(number >= 0, number),
            out.error: F.when(text.isNull() | (number >= 0), F.lit(None))
            .when(negative, _failed(text, "non-negative int"))
            .otherwise(_failed(text, "int")),
            out.text: number.cast("string"),
        },
    ]


def _spark_pattern(fmt: str) -> str:
    out = fmt.replace("T", "'T'")
    for directive, (pattern, _) in _DIRECTIVES.items():
        out = out.replace(directive, pattern)
    return out


def _shape(fmt: str) -> str:
    out = re.escape(fmt).replace(r"\%", "%").replace(r"\ ", r"\s+")
    for directive, (_, shape) in _DIRECTIVES.items():
        out = out.replace(directive, shape)
    return f"^{out}$"


def _read(text: Column, fmt: str) -> Column:
    """Text in the shape of ``fmt`` as a timestamp, else NULL.

    What begins with the year is read by a cast, which reads the same as the pattern at less cost.
    """
    if fmt.startswith("%Y-%m-%d"):
        parsed = text.try_cast("timestamp")
    else:
        parsed = F.try_to_timestamp(text, F.lit(_spark_pattern(fmt)))
    return F.when(text.rlike(_shape(fmt)), parsed)


def _naive(text: Column, formats: list[str]) -> Column:
    """First format that reads ``text``.

    A cheap shape test guards each parse, so a value is only handed to the
    formats that can match it instead of failing through the whole list.
    """
    return F.coalesce(*[_read(text, f) for f in formats])


def wall_text(wall: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, with six digits of a second only where there are any."""
    text = wall.cast("string")
    return F.when(F.length(text) > 19, F.rpad(text, 26, "0")).otherwise(text)


def iso_seconds(instant: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` in the form documents use."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss")


def instant_steps(
    source: Column, name: str, dtype: T.DataType | None = None, fmt: str | None = None
) -> Steps:
    """UTC instant from text in the caller's format or any of TIMESTAMP_FORMATS.

    A time without a zone is UTC. Columns that already hold timestamps pass
    through unchanged. The text keeps the wall clock and offset of the source
    (``2024-01-28 19:08:00+02:00``).
    """
    out = typed_names(name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        offset = "+00:00" if isinstance(dtype, T.TimestampType) else ""
        return [
            {out.value: source.cast("timestamp")},
            {
                out.error: F.lit(None).cast("string"),
                out.text: F.concat(wall_text(F.col(out.value)), F.lit(offset)),
            },
        ]

    order = ([fmt] if fmt else []) + [f for f in TIMESTAMP_FORMATS if f != fmt]
    zoned = [f.removesuffix("%z") for f in order if f.endswith("%z")]
    plain = [f for f in order if not f.endswith("%z")]
    text, zone = F.col(f"__{name}_clean"), F.col(f"__{name}_zone")
    wall, minutes = F.col(f"__{name}_wall"), F.col(f"__{name}_minutes")
    written = F.regexp_extract(text, f"T.*({_ZONE})$", 1)
    shown = F.col(f"__{name}_written")
    offset = F.when(F.length(shown) == 6, shown).otherwise(
        F.concat(F.substring(shown, 1, 3), F.lit(":"), F.substring(shown, 4, 2))
    )
    clock = F.expr(f"left(`__{name}_clean`, length(`__{name}_clean`) - length(`__{name}_written`))")
    sign = F.when(zone.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    parsed = (
        F.when(zone.isNull(), _naive(F.col(f"__{name}_clean"), plain))
        .when(F.abs(minutes) < 24 * 60, _naive(F.col(f"__{name}_clock"), zoned))
    )
    squeezed = F.regexp_replace(clean_text(source), r"\s+", " ")
    return [
        {f"__{name}_clean": squeezed},
        {f"__{name}_written": written},
        {
            f"__{name}_zone": F.when(F.col(f"__{name}_written") == "Z", F.lit("+00:00")).when(
                F.col(f"__{name}_written") != "", offset
            ),
            f"__{name}_clock": clock,
        },
        {
            f"__{name}_minutes": sign
            * (F.substring(zone, 2, 2).cast("int") * 60 + F.substring(zone, 5, 2).cast("int"))
        },
        {f"__{name}_wall": parsed},
        {
            out.value: F.when(zone.isNull(), wall).otherwise(
                F.timestamp_micros(F.unix_micros(wall) - minutes.cast("long") * 60_000_000)
            ),
            out.error: F.when(text.isNotNull() & wall.isNull(), _failed(text, "datetime")),
            out.text: F.concat(wall_text(wall), F.coalesce(zone, F.lit(""))),
        },
    ]


def wall_clock_to_utc(wall: Column, zone: Column | str) -> Column:
    """Instant of a wall-clock time in a named zone (JVM time-zone rules)."""
    return F.to_utc_timestamp(wall, zone)


def strict_wall_clock(col: Column, fmt: str) -> Column:
    """Wall-clock time in exactly one format, NULL where the text has another."""
    text = col.cast("string")
    return F.when(
        text.rlike(_shape(fmt)),
        F.try_to_timestamp(F.regexp_replace(text, r"\s+", " "), F.lit(_spark_pattern(fmt))),
    )


def truncate_schedule(instant: Column, schedule: str | None) -> Column:
    """Instant that identifies a scheduled run.

    A schedule of a day or longer, or none, keys runs by midnight; anything
    shorter keys them by minute.
    """
    words = ("@daily", "@weekly", "@monthly", "@yearly", "@once", "day", "week", "month", "year")
    daily = schedule is None or any(w in schedule.lower() for w in words)
    return F.date_trunc("day" if daily else "minute", instant)
