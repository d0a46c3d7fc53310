"""Data-quality rules as columns; failing rows are split off, not dropped."""

from __future__ import annotations

import zoneinfo
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.coerce import clean_status, clean_text
from tidemark.operators.lookup import lookup_join

# Fixed values
STATUSES = ("wet", "dirty", "mixed")
NAME_LENGTH = (3, 50)


@dataclass(frozen=True)
class Rule:
    """``passes`` must be TRUE; NULL counts as a failure."""

    name: str
    passes: Column


def name_length(col: str) -> Rule:
    return Rule("name_length", F.length(clean_text(F.col(col))).between(*NAME_LENGTH))


@cache
def zone_names() -> list[str]:
    """The names of the tz database that the JVM, which converts, knows (about 600)."""
    zones = SparkSession.active()._jvm.java.time.ZoneId
    known = {*zones.getAvailableZoneIds(), *zones.SHORT_IDS.keySet()}
    return sorted(known & zoneinfo.available_timezones())


def known_zone(col: str) -> Rule:
    return Rule("known_zone", F.col(col).isin(zone_names()))


def valid_status(col: str, allowed: Sequence[str] = STATUSES) -> Rule:
    return Rule("valid_status", clean_status(F.col(col)).isin(*allowed))


def not_future(col: str, now: Column) -> Rule:
    return Rule("not_future", F.col(col) <= now)


def positive(col: str, name: str | None = None) -> Rule:
    return Rule(name or f"positive_{col}", F.col(col) > 0)


def required(*cols: str) -> list[Rule]:
    return [Rule(f"required_{c}", F.col(c).isNotNull()) for c in cols]


def failed_rules(rules: Iterable[Rule]) -> Column:
    """Names of the failed rules in order, an empty array for a good row."""
    marks = [F.when(~F.coalesce(r.passes, F.lit(False)), F.lit(r.name)) for r in rules]
    return F.array_compact(F.array(*marks))


def first_failure(rules: Iterable[Rule]) -> Column:
    marks = [F.when(~F.coalesce(r.passes, F.lit(False)), F.lit(r.name)) for r in rules]
    return F.coalesce(*marks)


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children whose parent does not exist."""
    keys = parents.select(F.col(parent_key).alias(child_key))
    return children.join(keys, child_key, "left_anti")


def with_parents(
    children: DataFrame, parents: DataFrame, child_key: str, parent_key: str
) -> DataFrame:
    """Children whose parent exists."""
    keys = parents.select(F.col(parent_key).alias(child_key))
    return children.join(keys, child_key, "left_semi")


def ownership(
    requests: DataFrame, children: DataFrame, id_col: str, parent_col: str, along: str
) -> DataFrame:
    """Classifies (child id, claimed parent) requests.

    ``ok``: the child belongs to the parent; ``foreign_parent``: it belongs to
    another; ``not_found``: there is no such child. ``along`` is a number or
    time of a request that tells many requests for one child apart.
    """
    owners = children.select(F.col(id_col), F.col(parent_col).alias("__owner"), F.lit(1).alias("__hit"))
    verdict = (
        F.when(F.col("__hit").isNull(), "not_found")
        .when(F.col("__owner").eqNullSafe(F.col(parent_col)), "ok")
        .otherwise("foreign_parent")
    )
    return (
        lookup_join(requests, owners, id_col, along)
        .withColumn("ownership", verdict)
        .drop("__owner", "__hit")
    )
