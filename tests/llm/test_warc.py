"""Archives against SQL, a plain reader of the files, and lookups through small blocks."""

import gzip
import os

from tests.oracle_check import compare, connect
from trendengine.llm import warc

SF = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string, key string, sha int"


def test_query_is_the_sql(spark):
    assert compare(warc.query(spark, SF), connect(SF), warc.SQL) is None


def plain_records(root):
    """All records, read from start to end without the index."""
    for name in os.listdir(f"{root}/archive"):
        data = gzip.decompress(open(f"{root}/archive/{name}", "rb").read())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            size = next(int(x[16:]) for x in head.decode().split("\r\n") if x.startswith("Content-Length: "))
            assert head.startswith(b"WARC/1.1\r\n") and rest[size : size + 4] == b"\r\n\r\n"
            yield head.decode(), rest[:size]
            data = rest[size + 4 :]


def test_files_keys_and_lookups(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 3)
    monkeypatch.setattr(warc, "KEY", 12)
    same = "x\r\n\r\nWARC/1.1\r\n" * 3
    rows = [(i, "http://www.Example.org/hot", f"h{i}é", "k", 1) for i in range(40)]
    rows += [(100 + i, f"https://a{i % 7}.example.org/p/{i}?q#f", same if i % 2 else f"{i}", None, None) for i in range(40)]
    rows += [(7, "http://www.Example.org/hot", "h7é", "k", 1), (200, None, None, "k", 1), (201, "", "", "k", 1), (None, "no scheme", "h1é", "k", 1),
             (202, "http://b.org/\r\nWARC: x", "z" * 2_000_000, "k", 1)]
    pages = spark.createDataFrame(rows, SCHEMA)
    archive = warc.write_archive(spark, pages)
    assert archive.directory.count() >= len(rows) // 3
    assert len(list(plain_records(archive.root))) == len(rows)
    first = {}
    for i, _, html, *_ in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    def wanted(keep):
        out = []
        for i, url, html, *_ in rows:
            if keep(url):
                p, f = (html or "").encode(), first[html or ""]
                revisit = i is not None and i > f
                out.append((i, len(p), warc.digest(p), "revisit" if revisit else "response", f if revisit else None, None if revisit else p))
        return sorted(out, key=str)
    read = lambda urls: sorted((tuple(r[:5]) + (r[5] if r[5] is None else bytes(r[5]),) for r in warc.lookup(spark, archive, urls).collect()), key=str)
    assert read(pages) == wanted(lambda url: True)
    some = spark.createDataFrame([("ftp://www.example.org/hot",), ("http://a3.example.org/p/3?q#f",), ("http://zz/",), ("http://www.Example.org/hot",)], "url string")
    assert read(some) == wanted(lambda url: url in ("http://www.Example.org/hot", "https://a3.example.org/p/3?q#f"))


def test_neighbours_of_keys_that_fill_many_blocks(spark, monkeypatch):
    """Hot keys, a hot prefix of KEY characters and the key of null URLs, each over several index partitions, then keys in their last blocks."""
    monkeypatch.setattr(warc, "BLOCK", 5)
    monkeypatch.setattr(warc, "KEY", 20)
    urls = [None] * 61 + [f"http://h{h}.org/" for h in range(6) for _ in range(61)] + [f"http://h{h}.org/{k}" for h in range(6) for k in "abc"]
    urls += [f"http://z.org/{'p' * 40}/{k % 50:02}" for k in range(100)] + ["http://z.org/q", "http://z.org/r"]
    pages = spark.createDataFrame([(i, url, f"h{i}") for i, url in enumerate(urls)], "page_id long, url string, html string")
    set_to = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in set_to}
    try:
        for k, v in set_to.items():
            spark.conf.set(k, v)
        archive = warc.write_archive(spark, pages)
        assert archive.directory.select("file").distinct().count() > 12
        assert sorted(r.page_id for r in warc.lookup(spark, archive, pages).collect()) == list(range(len(urls)))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_least_bytes_and_empty(spark):
    pages = spark.createDataFrame([(2, "http://a/", "ab"), (1, "http://b/", "ab"), (4, "http://c/", "abc"), (3, "http://d/", "abc")], "page_id long, url string, html string")
    found = warc.lookup(spark, warc.write_archive(spark, pages, least=3), pages).collect()
    assert {r.page_id: r.refers_to for r in found} == {1: None, 2: None, 3: None, 4: 3}
    none = pages.where("false")
    assert warc.lookup(spark, warc.write_archive(spark, none), none).count() == 0
    assert warc.lookup(spark, warc.write_archive(spark, pages), none).count() == 0


def test_damage_is_noticed():
    member = warc.record(1, "http://a/", b"payload", "A" * 32, None)
    try:
        warc.parse(member)
    except ValueError:
        return
    raise AssertionError


def test_pages_are_not_shuffled_for_the_few_that_are_revisited(spark, monkeypatch):
    rows = [(i, f"http://a/{i}", f"h{i}") for i in range(50)] + [(60, "http://a/60", "h3"), (61, "http://a/61", "h3"), (2, "http://a/2", "h3"), (5, "http://a/5", "h5"), (None, "http://a/n", "h7")]
    pages, plans, real = spark.createDataFrame(rows, "page_id long, url string, html string"), [], warc._write_records
    monkeypatch.setattr(warc, "_write_records", lambda df, root: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, root))
    want = sorted([(60, 2), (61, 2), (3, 2)])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in (old, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            found = warc.lookup(spark, warc.write_archive(spark, pages), pages).collect()
            assert len(found) == len(rows) and sorted((r.page_id, r.refers_to) for r in found if r.record_type == "revisit") == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange hashpartitioning" not in plans[0] and "Exchange hashpartitioning" in plans[1]
