"""Tasks that write a landing."""

from pyspark.sql import DataFrameWriter, functions as F

from triplake import lake as lk
from triplake.sources.sinks import write_landings

TASK_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_a_landing_is_written_by_small_tasks(spark, monkeypatch):
    before, root, sizes = spark.conf.get(TASK_SIZE), lk.scratch_dir(spark, "small-tasks"), []
    text = DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, path: (sizes.append(spark.conf.get(TASK_SIZE)), text(self, path))[1])
    rows = spark.range(3000).select("id", F.date_add(F.lit("2022-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("d"))
    line = F.concat(F.lit("l"), F.col("id").cast("string"))
    write_landings(rows, root, {"a": (line, F.col("d")), "b": (F.when(F.col("id") % 3 > 0, line), F.date_add("d", 1))}, F.col("d"))
    assert sizes == [str(16 << 20)] and spark.conf.get(TASK_SIZE) == before
    a, b = (spark.read.text(lk.landing_root(root, f)) for f in "ab")
    assert a.count() == 3000 and b.count() == 2000 and a.select("event_date").distinct().count() == 40
    assert a.exceptAll(rows.select(line, F.col("d"))).count() == 0
