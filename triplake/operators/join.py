"""Request/outcome join of the live path.

Both sides are reduced to one row per key first (deterministic), then
inner-joined on the key, so the join is 1:1 and no key can multiply rows.
With plain key equality the two first-per-key aggregates and the sort-merge
join share one hash partitioning on the key: one exchange per input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from triplake.operators.dedupe import keep_first
from triplake.schemas import REQUEST_COLUMNS


def request_order(df: DataFrame, key: str = "unique_key",
                  ts: str = "trip_start_timestamp") -> list[str]:
    """First request per key: earliest start, then the other request fields."""
    others = [c for c in REQUEST_COLUMNS if c not in (key, ts) and c in df.columns]
    return [ts] + others


def first_requests(requests: DataFrame, key: str = "unique_key", method: str = "min_struct",
                   before: tuple[str, ...] = ()) -> DataFrame:
    """``before``: columns that order the requests of a key before their start."""
    cols = [c for c in requests.columns if c != "tips"]
    req = requests.select(*cols)
    return keep_first(req, [key], [*before, *request_order(req, key)], method=method)


def first_outcomes(outcomes: DataFrame, key: str = "unique_key", take: tuple[str, ...] = ("tips",),
                   method: str = "min_struct", before: tuple[str, ...] = ()) -> DataFrame:
    out = outcomes.select(key, *before, *take)
    return keep_first(out, [key], [*before, *take], method=method)


_KEY_PARTS = ["_key", "_keyless"]


def _never_null(df: DataFrame, key: str) -> DataFrame:
    """``df`` with its key as ``_key`` (text, "" for null) and ``_keyless``."""
    return df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"), F.col(key).isNull().alias("_keyless"),
                     *[c for c in df.columns if c != key])


def join_outcomes(requests: DataFrame, outcomes: DataFrame, key: str = "unique_key",
                  take: tuple[str, ...] = ("tips",), null_safe: bool = False,
                  method: str = "min_struct") -> DataFrame:
    """Inner join of the first request and the first outcome per key.

    Only the ``take`` fields come from the outcome; a request without an
    outcome yields nothing.  ``null_safe=True`` also pairs null keys (as a
    group-by-key runner would); the key then goes as two columns that are
    never null, so aggregates and join share one exchange per input here too.
    """
    if null_safe:
        kind = requests.schema[key].dataType
        req = keep_first(_never_null(requests.drop("tips"), key), _KEY_PARTS, request_order(requests, key), method=method)
        out = keep_first(_never_null(outcomes.select(key, *take), key), _KEY_PARTS, list(take), method=method)
        joined = req.join(out, on=_KEY_PARTS, how="inner").withColumn(key, F.when(~F.col("_keyless"), F.col("_key").cast(kind)))
    else:
        req = first_requests(requests, key, method)
        out = first_outcomes(outcomes, key, take, method)
        joined = req.join(out, on=key, how="inner")
    ordered = [c for c in requests.columns if c in joined.columns]
    extra = [c for c in take if c not in ordered]
    return joined.select(*ordered, *extra)


def pending_requests(requests: DataFrame, outcomes: DataFrame, key: str = "unique_key",
                     method: str = "min_struct") -> DataFrame:
    """First request per key for keys with no outcome yet (left anti join).

    A request without a key can match no outcome and no other request: each is pending.
    """
    req = first_requests(requests.where(F.col(key).isNotNull()), key, method)
    # distinct keys first: partial aggregation map side, so a key repeated in a
    # large share of the outcomes reaches the join as one row per map task
    keys = outcomes.select(key).where(F.col(key).isNotNull()).distinct()
    keyless = requests.where(F.col(key).isNull()).select(*req.columns)
    return req.join(keys, on=key, how="left_anti").unionByName(keyless)
