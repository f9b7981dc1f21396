"""Buckets are a task each, so their number follows the size of what they are made of."""

from triplake import lake as lk
from triplake.catalog import queries as q
from triplake.sources.bucketed import buckets_for


def test_buckets_grow_with_the_landing(spark, monkeypatch):
    assert buckets_for(0, 8) == 8 == buckets_for(8 * (24 << 20), 8) and buckets_for(7 << 30, 8) == 299
    folder = lk.scratch_dir(spark, "bytes")
    assert lk.folder_bytes(spark, folder) == 0
    lk.write_text(spark, f"{folder}/a/b", "x" * 100)
    assert lk.folder_bytes(spark, folder) == 100
    used = []
    monkeypatch.setattr(q, "write_bucketed", lambda df, table, path, buckets: used.append(buckets))
    monkeypatch.setattr(q, "read_requests", lambda *a: None)
    monkeypatch.setattr(q, "read_outcomes", lambda *a: None)
    monkeypatch.setattr(q.lk, "folder_bytes", lambda *a: 1 << 30)
    lake = q._Lake(spark, "none")
    monkeypatch.setattr(lake, "live", lambda: folder)
    lake.bucketed()
    assert used == [buckets_for(1 << 30, q.BUCKETS)] * 2 and used[0] > q.BUCKETS
