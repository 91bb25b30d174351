import gzip
import hashlib

import __spark_entry__ as contract

from tests.conftest import SF
from tidemark.llm import files, warc
from tidemark.session import scratch_folder


def expected(rows):
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "")]
        keep = max((p for p in same if p is not None), default=None)
        out.append((page_id, len(body), warc.base32(hashlib.sha1(body).digest()), keep if len(same) > 1 else page_id))
    return out


def check(got, rows):
    by = {}
    for r in got:
        by.setdefault((r.page_id, r.payload_digest), []).append(r)
    for page_id, size, digest, keep in expected(rows):
        found = by[page_id, digest]
        assert {r.payload_bytes for r in found} == {size}
        if page_id != keep:
            assert {(r.record_type, r.refers_to) for r in found} == {("revisit", keep)}
        else:
            assert sorted(r.record_type for r in found) == ["response"] + ["revisit"] * (len(found) - 1)
    assert len(got) == len(rows)


def test_query_matches_pages(spark, table):
    rows = [(r.page_id, r.url, r.html) for r in table("pages").collect()]
    check(contract.queries()["op2_warc_archives"](spark, SF).collect(), rows)


ROWS = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, None, None), (4, "http://a/\r\nX: y", ""), (5, "http://a/5", "ü" * 70_000),
        (5, "http://a/5", "ü" * 70_000), (None, "http://a/n", "<p>x</p>"), (None, "http://b", "only"), (6, "http://c", "a\r\n\r\nb"), (7, "http://c", "WARC/1.1\r\n")]
SCHEMA = "page_id long, url string, html string"


def test_odd_rows_and_names(spark, clash):
    folder = scratch_folder(spark)
    pages = clash(spark.createDataFrame(ROWS, SCHEMA))
    got = warc.read(warc.write(pages, folder, shard_bytes=60_000, roll_bytes=2_000), folder)
    check(got.collect(), ROWS)
    assert got.select("file").distinct().count() > 2


def test_same_bytes_again(spark, table):
    pages, sums = table("pages"), []
    for parts in (1, 7):
        folder = scratch_folder(spark)
        manifest = warc.write(pages.repartition(parts), folder, shard_bytes=40_000, roll_bytes=8_000).collect()
        for r in manifest:
            data = files.open_file(f"{folder}/{r.file}").readall()
            assert hashlib.sha1(data).hexdigest() == r.sha1 and len(data) == r.bytes
            assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        sums.append(sorted((r.file, r.records, r.sha1) for r in manifest))
    assert sums[0] == sums[1] and len(sums[0]) > 3
    where, path = files.store(folder)
    left = [f for f in where.get_file_info(files.fs.FileSelector(f"{path}/{files.TEMPORARY}")) if f.base_name.endswith(".gz")]
    assert left == []


def test_names_may_be_given_twice(spark):
    folder = scratch_folder(spark)
    with files.create(f"{folder}/a-1") as out:
        out.write(b"x")
    rows = spark.createDataFrame([(f"{folder}/a-1", "a"), (f"{folder}/a-1", "a")], "temporary string, file string")
    assert files.publish(rows.coalesce(1), folder).count() == 2
    assert files.open_file(f"{folder}/a").readall() == b"x"


def test_small_payloads_are_not_compared(spark):
    folder = scratch_folder(spark)
    got = warc.read(warc.write(spark.createDataFrame(ROWS, SCHEMA), folder, min_revisit_bytes=100), folder).collect()
    assert sorted(r.page_id for r in got if r.record_type == "revisit") == [5]


def test_empty(spark):
    folder = scratch_folder(spark)
    assert warc.read(warc.write(spark.createDataFrame([], SCHEMA), folder), folder).count() == 0


def test_edges_follow_weights(spark):
    even = spark.createDataFrame([(i, 10) for i in range(1000)], "key long, weight long")
    cuts = files.edges(even, 1000)
    sizes = [b - a for a, b in zip([0, *cuts], [*cuts, 1000])]
    assert sum(sizes) == 1000 and max(sizes) <= 100
    far = spark.createDataFrame([(i, 10) for i in range(1000)] + [(2**62, 10), (-2**62, 10), (None, 5)], "key long, weight long")
    assert len(files.edges(far, 1000)) >= 10
    assert files.edges(even.limit(0), 10) == []
