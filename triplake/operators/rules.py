"""Declared validation rules and the ``problems`` column.

A rule is a name and a boolean Column that is true when the row is bad.
All failing rules are collected, in declaration order, into one
``array<string>`` column, evaluated per row inside whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from triplake.functions.scalars import in_closed_range, to_bigint, to_double, to_naive_ts
from triplake.schemas import (
    MAX_AREA, MAX_FARE, MAX_MILES, MAX_SECONDS,
    MIN_AREA, MIN_FARE, MIN_MILES, MIN_SECONDS,
)


@dataclass(frozen=True)
class Rule:
    name: str
    bad: Column


def _typed(schema: T.StructType, name: str) -> tuple[Column, T.DataType]:
    if name in schema.fieldNames():
        return F.col(name), schema[name].dataType
    return F.lit(None).cast("string"), T.StringType()


def trip_rules(schema: T.StructType) -> list[Rule]:
    """The six trip rules, built for the column types of ``schema``.

    Duration, distance, fare and tips are compared as parsed doubles; the
    pickup area as the truncated integer.  The dropoff area is not checked.
    """
    ts = to_naive_ts(*_typed(schema, "trip_start_timestamp"))
    seconds = to_double(*_typed(schema, "trip_seconds"))
    miles = to_double(*_typed(schema, "trip_miles"))
    fare = to_double(*_typed(schema, "fare"))
    tips = to_double(*_typed(schema, "tips"))
    pickup = to_bigint(*_typed(schema, "pickup_community_area"))
    return [
        Rule("missing_start_ts", ts.isNull()),
        Rule("bad_duration", ~in_closed_range(seconds, float(MIN_SECONDS), float(MAX_SECONDS))),
        Rule("bad_distance", ~in_closed_range(miles, MIN_MILES, MAX_MILES)),
        Rule("bad_fare", ~in_closed_range(fare, MIN_FARE, MAX_FARE)),
        Rule("bad_tips", ~F.coalesce(tips >= F.lit(0.0), F.lit(False))),
        Rule("bad_pickup_area", ~in_closed_range(pickup, MIN_AREA, MAX_AREA)),
    ]


def problems_column(rules: list[Rule]) -> Column:
    """Names of every failing rule, in rule order (empty array = valid)."""
    return F.array_compact(F.array(*[F.when(r.bad, F.lit(r.name)) for r in rules]))


def any_problem(rules: list[Rule]) -> Column:
    """True when at least one rule fails (no array is built)."""
    out = F.lit(False)
    for r in rules:
        out = out | F.coalesce(r.bad, F.lit(False))
    return out


def rule_flags(df: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One boolean column per rule, named after the rule."""
    rules = trip_rules(df.schema) if rules is None else rules
    return df.select("*", *[F.coalesce(r.bad, F.lit(False)).alias(r.name) for r in rules])
