"""Hot keys: one key holding a third of all rows must not reach one task whole,
and must never multiply rows in a join."""

from pyspark.sql import functions as F

from triplake.functions.scalars import epoch_ntz
from triplake.operators.dedupe import keep_first
from triplake.operators.join import join_outcomes, pending_requests


def _hot(spark, n=30000):
    # a third of the rows share key "hot"; the rest are unique
    return (spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 1000).alias("x"), F.col("id").alias("y")).repartition(8))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_pre_aggregates_before_the_shuffle(spark):
    df = _hot(spark)
    for method in ("min_struct", "window"):
        out = keep_first(df, ["k"], ["x", "y"], method=method)
        plan = _plan(out)
        marker = "partial_min" if method == "min_struct" else "Partial"
        # the partial step sits below (after, in the printed tree) the key exchange
        assert plan.index("Exchange hashpartitioning(k") < plan.index(marker)
        hot = out.where("k = 'hot'").collect()
        assert len(hot) == 1 and (hot[0].x, hot[0].y) == (0, 0)
        assert out.count() == 1 + 20000


def test_join_of_hot_keys_is_one_to_one(spark):
    req = _hot(spark).select(F.col("k").alias("unique_key"),
                             F.timestamp_add("SECOND", F.col("y"), epoch_ntz()).alias("trip_start_timestamp"),
                             F.col("x").cast("double").alias("fare"))
    out = _hot(spark).select(F.col("k").alias("unique_key"), F.col("x").cast("double").alias("tips"))
    joined = join_outcomes(req, out)
    assert joined.count() == 20001                      # never all pairs of the 10000 x 10000 hot rows
    assert joined.where("unique_key = 'hot'").first().tips == 0.0
    assert pending_requests(req, out.where("unique_key <> 'hot'")).count() == 1
    assert "partial_min" in _plan(joined)
