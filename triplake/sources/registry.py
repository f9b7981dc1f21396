"""Source registry: name -> (reader, silver dataset folder).

Every reader returns the typed RAW shape, so the clean plan is the same
whichever source fed it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from triplake.schemas import HISTORICAL_DATASET, LIVE_DATASET
from triplake.sources.historical import read_historical
from triplake.sources.landing import read_live

Reader = Callable[..., DataFrame]


def _historical(spark: SparkSession, *, raw, start, end, **_) -> DataFrame:
    return read_historical(spark, raw, start, end)


def _live(spark: SparkSession, *, out_lake: str, start, end, **_) -> DataFrame:
    return read_live(spark, out_lake, start, end)


# source name -> (reader, dataset folder, how the clean plan materialises it)
SOURCES: dict[str, tuple[Reader, str, str]] = {
    "historical": (_historical, HISTORICAL_DATASET, "rescan"),
    "live": (_live, LIVE_DATASET, "stage"),
}
