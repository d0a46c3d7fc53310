"""Coercions, hashes, keys and mappings against hand-derived values."""

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import coerce as c
from tidemark.functions.hashing import derived_id, row_hash
from tidemark.functions.keys import clock_text, date_key, month_key, time_key
from tidemark.plans import mappings as m
from tidemark.plans.staging import split_rows


def column(spark, values, steps, name="x"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    out = c.typed_names(name)
    rows = c.add_typed(df, steps(F.col("v"), name)).orderBy("i").select(
        F.col(out.value).alias("value"), F.col(out.error).alias("error"), F.col(out.text).alias("text")
    )
    return [tuple(r) for r in rows.collect()]


def test_blank_text_is_null(spark):
    got = column(spark, [None, "", "   ", "  trimmed  ", "0", " \tx\n"], c.text_steps)
    assert [v for v, _, _ in got] == [None, None, None, "trimmed", "0", "x"]


@pytest.mark.parametrize(
    ("raw", "value", "error"),
    [
        ("  42  ", 42, None), ("", None, None), (None, None, None), ("+5", 5, None), ("0", 0, None),
        ("-0", 0, None), ("not-an-int", None, "Cannot convert 'not-an-int' to int"),
        ("12.0", None, "Cannot convert '12.0' to int"), ("-3", None, "Cannot convert '-3' to non-negative int"),
        ("99999999999", None, "Cannot convert '99999999999' to int"),
        ("-99999999999", None, "Cannot convert '-99999999999' to non-negative int"),
    ],
)
def test_non_negative_int(spark, raw, value, error):
    assert column(spark, [raw], c.int_steps)[0][:2] == (value, error)


def test_timestamp_formats(spark):
    same = [
        "2024-02-02T08:00:00+00:00", "2024-02-02T08:00+00:00", "2024-02-02 08:00", "2024-02-02 08:00:00",
        "2024-02-02T08:00", "2024-02-02T08:00:00", "02.02.2024, 08:00", "2.2.2024 8:00", "02/02/2024 08:00",
        "2024-02-02T10:00+0200", "2024-02-02T03:00:00-05:00", "2024-02-02T08:00:00Z", " 02.02.2024,   08:00 ",
    ]
    got = column(spark, same, lambda s, n: c.instant_steps(s, n, fmt="%d.%m.%Y, %H:%M"))
    assert {v for v, _, _ in got} == {datetime(2024, 2, 2, 8)} and all(e is None for _, e, _ in got)
    assert got[9][2] == "2024-02-02 10:00:00+02:00" and got[11][2] == "2024-02-02 08:00:00+00:00"
    assert got[2][2] == "2024-02-02 08:00:00"
    odd = ["05/06/2024 08:00", "06/25/2024 08:00", "31.02.2024, 08:00", "2024-02-02T08:00:00.5", "soon",
           "2024-02-02 08:00+00:00", "2024-02-02T08:00+25:00", None]
    got = column(spark, odd, c.instant_steps)
    assert [v for v, _, _ in got] == [datetime(2024, 6, 5, 8), datetime(2024, 6, 25, 8), *[None] * 6]
    assert [e is None for _, e, _ in got] == [True, True, False, False, False, False, False, True]


def test_row_hash(spark):
    df = spark.range(1).select(
        row_hash([F.lit(1), F.lit("Anna"), F.lit("Europe/Chisinau")]).alias("h"),
        row_hash([F.lit(1), F.lit(None)]).alias("n"),
    )
    row = df.first()
    assert row.h == hashlib.sha256(b"1|Anna|Europe/Chisinau").hexdigest()
    assert row.n == hashlib.sha256(b"1|None").hexdigest()


def test_derived_id(spark):
    want = hashlib.sha256(b"2026-01-01T08:00:00|7").hexdigest()[:16]
    got = spark.range(1).select(
        derived_id(F.lit("2026-01-01 08:00:00"), F.lit(7)), derived_id(F.lit(None), F.lit(7))
    ).first()
    assert got[0] == want and got[1] == hashlib.sha256(b"None|7").hexdigest()[:16]


def test_keys(spark):
    ts = F.lit("2024-03-05 07:09:59").cast("timestamp_ntz")
    row = spark.range(1).select(
        date_key(ts), time_key(ts), month_key(date_key(ts)), clock_text(F.hour(ts), F.minute(ts))
    ).first()
    assert tuple(row) == (20240305, 709, 202403, "07:09")


def test_schedules(spark):
    ts = F.lit("2024-03-05 07:09:59").cast("timestamp_ntz")
    cases = {"@daily": 0, "1 day, 0:00:00": 0, None: 0, "@once": 0, "@hourly": 7, "0 1 * * *": 7}
    for schedule, hour in cases.items():
        got = spark.range(1).select(c.truncate_schedule(ts, schedule)).first()[0]
        assert (got.hour, got.second) == (hour, 0)


def test_mapping_ignores_extra_and_fills_missing_columns(spark):
    df = spark.createDataFrame([("5", "x")], "id string, extra string")
    row = m.map_rows(df, m.STATUS_TABLE).first()
    assert (row.source_id, row.change_time, row.status, row.baby_id) == (5, None, None, None)
    assert row.row_hash == hashlib.sha256(b"5|None|None|None").hexdigest()


def test_first_bad_field_is_reported_and_the_parent_given_wins(spark):
    df = spark.createDataFrame(
        [("x", "never", "wet", "9"), ("1", "never", "wet", "-9"), ("2", "2024-01-01 08:00", " wet ", "9")],
        "id string, change_time string, status string, baby_id string",
    )
    good, bad = split_rows(m.map_rows(df, m.STATUS_DOCUMENT, F.lit(4)))
    assert sorted(r.error_message for r in bad.collect()) == [
        "Cannot convert 'never' to datetime", "Cannot convert 'x' to int"]
    row = good.first()
    assert (row.baby_id, row.status, row.change_time) == (4, "wet", datetime(2024, 1, 1, 8))
    assert '"status":"wet"' in bad.first().raw


def test_custom_coercion(spark):
    def shout(source, name):
        out = c.typed_names(name)
        return [{out.value: F.upper(source), out.error: F.lit(None).cast("string"), out.text: F.upper(source)}]

    spec = m.Mapping("loud", (m.Field("source_id", "id", "int"), m.Field("name", "name", shout)))
    row = m.map_rows(spark.createDataFrame([("1", "ann")], "id string, name string"), spec).first()
    assert row.name == "ANN"


@pytest.mark.parametrize("kind, values", [("long", [0, 7, -1, 2**31 - 1, 2**31, -(2**31) - 1, -(2**63), None]), ("short", [3, -3, None])])
def test_whole_numbers_are_typed_as_their_texts(spark, kind, values):
    rows = spark.createDataFrame([(v,) for v in values], f"v {kind}").coalesce(1)
    names = [f"__n_{x}" for x in ("value", "error", "text")]
    direct = c.add_typed(rows, c.int_steps(F.col("v"), "n", rows.schema["v"].dataType)).select(names).collect()
    assert direct == c.add_typed(rows, c.int_steps(F.col("v").cast("string"), "n")).select(names).collect()


def test_texts_that_begin_with_the_year_are_read_as_by_their_pattern(spark):
    texts = ["0000-01-05 10:00", "0001-1-5 9:05", "2023-02-29 10:00", "2024-01-05T24:00", "2024-02-29T1:02:03Z"]
    rows = spark.createDataFrame([(v,) for v in texts], "v string").coalesce(1)
    got = c.add_typed(rows, c.instant_steps(F.col("v"), "t")).select("__t_text", F.col("__t_error").isNull()).collect()
    read = ["0000-01-05 10:00:00", "0001-01-05 09:05:00", None, None, "2024-02-29 01:02:03+00:00"]
    assert [tuple(r) for r in got] == [(x, x is not None) for x in read]
