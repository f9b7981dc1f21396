import base64
import gzip
import hashlib
import json

import pytest

from triplake import lake as lk
from triplake.llm import url_filter as uf, warc


def judged(spark, rows, more=None):
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    return {r.page_id: (r["rule"], r.verdict) for r in uf.judge(pages, uf.rule_table(spark), more).collect()}


def link(to):
    return f'<html><head><LINK href="{to}" rel=canonical></head>'


def test_rules_and_longest_match(spark):
    rows = [(1, "http://a.org/x", None), (2, "https://EXAMPLE.com/en/1?q#f", ""), (3, "http://www.example.com/en/1", ""),
            (4, "http://x.www.example.com/en/", ""), (5, "http://com", ""), (6, "http://notexample.com/en/", ""),
            (7, "http://b.net/es/", ""), (8, "http://b.net/ES/", ""), (9, None, None), (10, "nonsense", ""), (11, "http://u://net/fr/", ""),
            (12, "http://net/fr/?a=http://x.com/", "")]
    got = judged(spark, rows)
    assert got == {1: (None, "allow"), 2: ("example.com/en/", "block"), 3: ("www.example.com/en/", "allow"),
                   4: ("www.example.com/en/", "allow"), 5: (None, "allow"), 6: ("com/", "allow"), 7: ("net/es/", "block"),
                   8: (None, "allow"), 9: (None, "allow"), 10: (None, "allow"), 11: (None, "allow"), 12: ("net/fr/", "block")}


def test_aliases_carry_decisions(spark):
    rows = [(1, "http://a.org/1", link("http://b.net/es/9")),  # alias of a blocked address
            (2, "https://A.org/1#top", ""),  # the same address
            (3, "http://c.org/2", '<meta content="0; url=/3" http-equiv="refresh">'), (4, "http://c.org/3", link("//a.org/1")),
            (5, "http://d.org/", link("http://b.net/fr/1")), (6, "http://d.org", link("http://ok.com/&amp;a")),  # allow goes first
            (7, "http://e.org/dir/page", link("other")), (8, "http://e.org/dir/other", ""), (None, "http://a.org/1", ""),
            (9, "http://f.org/9", "")]
    got = judged(spark, rows)
    assert {k: v[1] for k, v in got.items()} == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow",
                                                  7: "allow", 8: "allow", None: "block", 9: "allow"}
    more = spark.createDataFrame([("e.org/dir/other", "b.net/es/1"), ("f.org/9", "f.org/9")], "src string, dst string")
    got = judged(spark, rows, more)
    assert (got[7][1], got[8][1], got[9][1]) == ("block", "block", "allow")


def test_no_pages(spark):
    assert judged(spark, []) == {}


PAGES = [(1, "http://a/1", "same"), (2, "http://a/2", "other é" * 2000), (3, None, "same"), (4, "http://a/4\r\nX: y", ""), (5, "u", None),
         (6, "u", "HTTP/1.1\r\n\r\nWARC/1.1\r\n\r\n"), (9, "u", "same"), (None, "u", "same"), (None, "u", "alone"), (9, "u", "same")]


def test_round_trip_and_revisits(spark):
    df = spark.createDataFrame([(*p, "z") for p in PAGES], "page_id long, url string, html string, digest string")
    archives = warc.write_monolithic(warc.with_revisits(df), lk.scratch_dir(spark, "test-warc"), archive_bytes=4000)
    index = warc.normalise(archives)
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_records(index).collect())
    want = []
    for page_id, _, html in PAGES:
        raw = (html or "").encode()
        last = max((i for i, _, h in PAGES if i is not None and (h or "") == (html or "")), default=None)
        refers = None if last is None or page_id == last else last
        want.append((str(page_id), len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                     "response" if refers is None else "revisit", refers))
    assert got == sorted(want)
    for a in {r.archive for r in index.collect()}:  # members one by one, as the sidecar says
        path = "/" + a.split(":", 1)[-1].lstrip("/")
        raw = open(path, "rb").read()
        side = [json.loads(x) for x in open(path.removesuffix(".warc.gz") + ".index")]
        assert sum(r["length"] for r in side) == len(raw)
        assert all(gzip.decompress(raw[r["offset"]:r["offset"] + r["length"]]).startswith(b"WARC/1.1\r\n") for r in side)


def test_members_in_the_source_and_cut_files(tmp_path):
    recs = [warc.record(i, "u", b"x" * (i * 70_000), "D", None) for i in range(6)]
    whole, members = tmp_path / "a.gz", tmp_path / "b.gz"
    whole.write_bytes(gzip.compress(b"".join(recs)))
    members.write_bytes(b"".join(map(gzip.compress, recs)))
    for p in (whole, members):
        with open(p, "rb") as f:
            assert [raw for _, raw in warc.records(f)] == recs
    (tmp_path / "c.gz").write_bytes(gzip.compress(b"".join(recs)[:-9]))
    with open(tmp_path / "c.gz", "rb") as f, pytest.raises(ValueError):
        list(warc.records(f))


def test_no_archives(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    archives = warc.write_monolithic(warc.with_revisits(df), lk.scratch_dir(spark, "test-warc"))
    assert warc.read_records(warc.normalise(archives)).count() == 0
