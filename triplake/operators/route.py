"""Scope filter, three-way routing, reject records and clean projection.

Routing is expressed as predicates over the ``_ok`` flag (an OR of the
rules) next to the ``problems`` array, so the valid and rejected frames
are two filters over the same logical plan; the clean plan decides whether
that plan is re-scanned or materialised once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from triplake.functions.scalars import (
    default_if_empty, default_strip, to_bigint, to_double, to_naive_ts,
)
from triplake.operators.rules import Rule, any_problem, problems_column, trip_rules
from triplake.schemas import (
    DEFAULT_COMPANY, DEFAULT_TAXI_ID, RAW_SCHEMA, SCOPE_COLUMN, SCOPE_VALUE, SILVER_COLUMNS,
)


def scope_condition(column: str = SCOPE_COLUMN, value: str = SCOPE_VALUE) -> Column:
    """True only when ``column`` equals ``value`` exactly (null is out)."""
    return F.coalesce(F.col(column) == F.lit(value), F.lit(False))


def in_scope(df: DataFrame, column: str = SCOPE_COLUMN, value: str = SCOPE_VALUE) -> DataFrame:
    """Rows with ``column == value``.  As a filter, a null comparison drops the
    row just like false, and the bare equality reaches the Parquet scan."""
    return df.where(F.col(column) == F.lit(value))


OK_COLUMN = "_ok"


def flag(df: DataFrame, rules: list[Rule] | None = None, scope: bool = True) -> DataFrame:
    """In-scope rows with a ``problems`` array and an ``_ok`` flag appended.

    Filters use ``_ok`` (an OR of the rules), so a plan that keeps only
    valid rows never builds the array: Catalyst prunes it.
    """
    rules = trip_rules(df.schema) if rules is None else rules
    rows = in_scope(df) if scope else df
    return rows.select("*", problems_column(rules).alias("problems"),
                       (~any_problem(rules)).alias(OK_COLUMN))


def _is_ok(flagged: DataFrame) -> Column:
    return F.col(OK_COLUMN) if OK_COLUMN in flagged.columns else F.size("problems") == 0


def valid_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(_is_ok(flagged)).drop("problems", OK_COLUMN)


def rejected_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(~_is_ok(flagged)).drop(OK_COLUMN)


def route_column(rules: list[Rule], column: str = SCOPE_COLUMN, value: str = SCOPE_VALUE) -> Column:
    """'filtered' | 'rejected' | 'valid' for every input row."""
    return (F.when(~scope_condition(column, value), F.lit("filtered"))
            .when(any_problem(rules), F.lit("rejected"))
            .otherwise(F.lit("valid")))


def route_counts(df: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row: input, filtered, rejected and valid row counts (one scan)."""
    rules = trip_rules(df.schema) if rules is None else rules
    r = route_column(rules)
    return df.select(r.alias("route")).agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(F.col("route") == "filtered").alias("filtered_rows"),
        F.count_if(F.col("route") == "rejected").alias("rejected_rows"),
        F.count_if(F.col("route") == "valid").alias("valid_rows"),
    )


def route_aggregates(in_scope: Column, ok: Column) -> list[Column]:
    """The same counts as aggregate columns, for an aggregation or an observation of rows with these flags."""
    return [
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(~in_scope).alias("filtered_rows"),
        F.count_if(in_scope & ~ok).alias("rejected_rows"),
        F.count_if(in_scope & ok).alias("valid_rows"),
    ]


def problem_counts(flagged: DataFrame) -> DataFrame:
    """Rows per problem name (a row with several problems counts in each)."""
    return (flagged.select(F.explode("problems").alias("problem"))
            .groupBy("problem").agg(F.count(F.lit(1)).alias("n_rows")))


def reject_records(flagged: DataFrame, key: str = "unique_key",
                   raw_columns: list[str] | None = None) -> DataFrame:
    """``{unique_key, problems, raw}``; raw holds every input field as text, nulls kept."""
    cols = raw_columns or [c for c in flagged.columns if c not in ("problems", OK_COLUMN)]
    types = {f.name: f.dataType for f in flagged.schema.fields}

    def text(c: str) -> Column:  # instants as UTC wall time, whatever the session's zone
        value = to_naive_ts(F.col(c), types[c]) if isinstance(types[c], T.TimestampType) else F.col(c)
        return value.cast("string")

    raw = F.create_map(*[x for c in cols for x in (F.lit(c), text(c))])
    return rejected_rows(flagged).select(
        F.col(key).cast("string").alias("unique_key"),
        F.col("problems"),
        raw.alias("raw"),
    )


def clean_projection(df: DataFrame) -> DataFrame:
    """Typed silver projection of valid rows (12 columns, fixed order)."""
    s = df.schema

    def typed(name: str) -> tuple[Column, T.DataType]:
        if name in s.fieldNames():
            return F.col(name), s[name].dataType
        return F.lit(None).cast("string"), T.StringType()

    cols = {
        "unique_key": F.col("unique_key").cast("string"),
        "taxi_id": default_if_empty(F.col("taxi_id").cast("string"), DEFAULT_TAXI_ID),
        "trip_start_ts": to_naive_ts(*typed("trip_start_timestamp")),
        "trip_seconds": to_bigint(*typed("trip_seconds")),
        "trip_miles": to_double(*typed("trip_miles")),
        "fare": to_double(*typed("fare")),
        "tips": to_double(*typed("tips")),
        "pickup_community_area": to_bigint(*typed("pickup_community_area")),
        "dropoff_community_area": to_bigint(*typed("dropoff_community_area")),
        "tolls": F.coalesce(to_double(*typed("tolls")), F.lit(0.0)),
        "extras": F.coalesce(to_double(*typed("extras")), F.lit(0.0)),
        "company": default_strip(F.col("company").cast("string"), DEFAULT_COMPANY),
    }
    return df.select(*[cols[c].alias(c) for c in SILVER_COLUMNS])


def conform_raw(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Any raw-shaped frame (text or typed values) -> typed RAW schema.

    Fields missing from the input are null; extra fields are dropped unless
    named in ``keep`` (appended unchanged).
    """
    s = df.schema
    out = []
    for f in RAW_SCHEMA.fields:
        if f.name not in s.fieldNames():
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c, t = F.col(f.name), s[f.name].dataType
        if isinstance(f.dataType, T.TimestampNTZType):
            v = to_naive_ts(c, t)
        elif isinstance(f.dataType, T.LongType):
            v = to_bigint(c, t)
        elif isinstance(f.dataType, T.DoubleType):
            v = to_double(c, t)
        else:
            v = c.cast("string")
        out.append(v.alias(f.name))
    return df.select(*out, *[F.col(c) for c in (keep or [])])


__all__ = [
    "scope_condition", "in_scope", "flag", "valid_rows", "rejected_rows", "route_column",
    "route_counts", "problem_counts", "reject_records", "clean_projection", "conform_raw",
]
