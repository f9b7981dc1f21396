"""Gold assembly, split summary and manifest content."""

from __future__ import annotations

import dataclasses
import datetime as dt
import json

from pyspark.sql import DataFrame, functions as F

from triplake.functions.features import feature_columns, label_column
from triplake.schemas import FEATURE_COLUMNS, GOLD_COLUMNS, ID_COLUMNS, TIP_THRESHOLD


def to_gold(df: DataFrame, ts: str = "trip_start_ts") -> DataFrame:
    """ids + split + 17 features + label, in ``GOLD_COLUMNS`` order."""
    out = df.select(*[F.col(c) for c in ID_COLUMNS], F.col("split"),
                    *feature_columns(ts), label_column())
    assert out.columns == GOLD_COLUMNS
    return out


def split_summary(gold: DataFrame, ts: str = "trip_start_ts") -> DataFrame:
    """Per split: rows, label rate (4 decimals), first and last trip."""
    return gold.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg("label"), 4).alias("label_rate"),
        F.min(ts).alias("first_trip"),
        F.max(ts).alias("last_trip"),
    )


def split_records(gold: DataFrame, ts: str = "trip_start_ts") -> DataFrame:
    """The summary as the manifest holds it: (split, record), the times as text."""
    s = split_summary(gold, ts)
    return s.select("split", F.struct("rows", "label_rate", F.col("first_trip").cast("string").alias("first_trip"),
                                      F.col("last_trip").cast("string").alias("last_trip")).alias("record"))


@dataclasses.dataclass
class Manifest:
    """What a gold version says about itself; field names are the file's keys (fixed values)."""
    gold_version: str
    created_at: str
    silver_path: str
    git_commit: str
    label: str
    feature_columns: list[str]
    split_rule: dict
    splits: dict

    def to_json(self) -> str:
        return json.dumps(dataclasses.asdict(self), indent=2)


def manifest(gold: DataFrame, *, version: str, silver_path: str, git_commit: str, split_rule: dict,
             created_at: dt.datetime | None = None) -> Manifest:
    """Manifest of a written gold version; its records (one a split, so at most three) come from that data."""
    records = {r.split: r.record.asDict() for r in split_records(gold).collect()}
    moment = created_at or dt.datetime.now(dt.timezone.utc)
    return Manifest(version, moment.isoformat(), silver_path, git_commit, f"tips / fare > {TIP_THRESHOLD}",
                    list(FEATURE_COLUMNS), split_rule, records)
