"""WARC archives of pages, and a two-level capture index to read them by.

Writing. Every page becomes a record, a gzip member of its own, in one archive file per task. Of pages with equal payloads of
``LEAST`` bytes or more, the one with the smallest page_id is a response, the others are revisits that carry its headers
and refer to it; shorter payloads are all responses. Pages without page_id are responses that nothing refers to.

Index. Captures are sorted by key, the URL with its host reversed (``org,example,www)/path?query``), and written in compressed
blocks of ``BLOCK`` captures or, beyond ``BLOCKS`` blocks, larger ones, so that the directory (the first and last key of
each block, cut to ``KEY`` characters, and its place) stays small enough to broadcast at any size. The directory is in the order
of the captures, by range partition and block, so blocks that share a first key keep it. A lookup searches the directory by
bisection for all blocks whose range covers the key, reads each by its range, bisects its keys and reads each record by its range.

Files are written through `pyarrow.fs` below ``spark.checkpoint.dir``, under names no other attempt uses; only rows of tasks that
Spark commits point at them, so lost executors and repeated tasks leave unused files at worst. A URL or payload shared by a third of
all pages is split: equal payloads by Spark's skew join, equal keys over several blocks. Only payloads that some page revisits are
joined to the pages; where they are few, Spark sends them and no page is shuffled.

A null html is an empty payload, a null url an empty key. Repeated rows are records of their own.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendengine.llm.common import ROWS_AT_ONCE, stored, table
from trendengine.session import scratch_path

LEAST = 0
BLOCK = 3000
BLOCKS = 1 << 16
BLOCKS_PER_TASK = 2
KEY = 200
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = "key string, file string, offset long, length long"
DIRECTORY = "part int, block int, first string, last string, file string, offset long, length long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


@dataclass
class Archive:
    root: str
    directory: DataFrame


def capture_key(url):
    """Host reversed, then the rest; no scheme."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    turned = F.array_join(F.reverse(F.split(F.lower(host), r"\.")), ",")
    return F.concat(turned, F.lit(")"), F.substr(rest, F.length(host) + 1))


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, sha: str, refers_to: int | None) -> bytes:
    """A WARC record, compressed as a member of its own."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_name(page_id)}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    head += [
        f"WARC-Target-URI: {target}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{sha}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], int, bytes]:
    """(WARC headers, length of the payload, payload; empty for a revisit) of a compressed record. Checks its digest."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(line[16:]) for line in http.decode().split("\r\n") if line.startswith("Content-Length: "))
    if fields["WARC-Type"] == "response" and (len(payload) != size or "sha1:" + digest(payload) != fields["WARC-Payload-Digest"]):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return fields, size, payload


def _open(root: str):
    """(file system, path below it) of a folder given as URI or absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)


def _write_records(pages: DataFrame, root: str) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        system, folder = _open(root)
        system.create_dir(folder, recursive=True)
        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
        with system.open_output_stream(f"{folder}/{name}", compression=None) as out:
            for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
                keys, places = [], []
                for key, page_id, url, html, first in zip(*(c.to_pylist() for c in batch.columns)):
                    payload = html.encode()
                    member = record(page_id, url, payload, digest(payload), first)
                    out.write(member)
                    keys.append(key)
                    places.append((offset, len(member)))
                    offset += len(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), pa.array([name] * len(keys), pa.string()), pa.array([p[0] for p in places], pa.int64()), pa.array([p[1] for p in places], pa.int64())],
                    ["key", "file", "offset", "length"],
                )

    return pages.select("key", "page_id", "url", "html", "refers_to").mapInArrow(run, CAPTURES)


def _write_blocks(captures: DataFrame, root: str, size: int) -> DataFrame:
    """Blocks of ``size`` captures of each sorted partition, and a directory row for each."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        system, folder = _open(root)
        system.create_dir(folder, recursive=True)
        part, name, offset, held, rows = TaskContext.get().partitionId(), f"{uuid.uuid4().hex}.idx", 0, [], []
        with system.open_output_stream(f"{folder}/{name}", compression=None) as out:

            def flush():
                nonlocal offset, held
                block = zlib.compress("\0".join(str(x) for row in held for x in row).encode())
                out.write(block)
                rows.append((part, len(rows), held[0][0][:KEY], held[-1][0][:KEY], name, offset, len(block)))
                offset, held = offset + len(block), []

            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    held.append((row[0].replace("\0", ""), *row[1:]))
                    if len(held) == size:
                        flush()
            if held:
                flush()
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()))],
            ["part", "block", "first", "last", "file", "offset", "length"],
        )

    return captures.mapInArrow(run, DIRECTORY)


def write_archive(spark: SparkSession, pages: DataFrame, least: int = LEAST) -> Archive:
    """Records of ``pages`` (page_id, url, html; other columns are left out) and the index over them."""
    root = scratch_path(spark, "warc")
    html = F.coalesce("html", F.lit(""))
    pages = pages.select(
        "page_id", "url", html.alias("html"), F.replace(capture_key(F.col("url")), F.lit("\0"), F.lit("")).alias("key"), F.sha1(html.cast("binary")).alias("sha")
    )
    places = [F.min("page_id").alias("first"), F.max("page_id").alias("last")]
    first = pages.where(F.octet_length("html") >= least).groupBy("sha").agg(*places).where(F.col("last") > F.col("first")).select("sha", "first")
    # only payloads with revisits, and stored, so that Spark knows how few they are: pages stay where they are if these can be sent to them
    judged = pages.join(stored(spark, first, "first"), "sha", "left").withColumn("refers_to", F.when(F.col("page_id") > F.col("first"), F.col("first")))
    captures = stored(spark, _write_records(judged, f"{root}/archive"), "captures")
    size = max(BLOCK, -(-captures.count() // BLOCKS))
    order = ["key", "file", "offset"]  # places break ties: a key that many captures share is dealt to several partitions
    dealt = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    return Archive(root, stored(spark, _write_blocks(dealt, f"{root}/index", size), "directory"))


def lookup(spark: SparkSession, archive: Archive, urls: DataFrame) -> DataFrame:
    """The records of all captures whose key is that of a row of ``urls`` (url), each once, with the payload of responses."""
    blocks = archive.directory.orderBy("part", "block").collect()  # BLOCKS rows and one per index file at most
    sent = spark.sparkContext.broadcast(([b["first"] for b in blocks], [b["last"] for b in blocks], [(b["file"], b["offset"], b["length"]) for b in blocks]))
    root = archive.root

    def find(batches: Iterator) -> Iterator:
        """The blocks that may hold a key."""
        import pyarrow as pa

        firsts, lasts, _ = sent.value
        for batch in batches:
            at, keys = [], []
            for key in batch.column(0).to_pylist():
                cut = key[:KEY]
                for block in range(bisect_left(lasts, cut), bisect_right(firsts, cut)):
                    at.append(block)
                    keys.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(keys, pa.string())], ["block", "key"])

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        _, _, places = sent.value
        system, folder = _open(root)
        held, rows = -1, []
        archive_file = opened = None
        for batch in batches:
            wanted = []
            for block, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if block != held:
                    name, offset, length = places[block]
                    with system.open_input_file(f"{folder}/index/{name}") as file:
                        file.seek(offset)
                        cells = zlib.decompress(file.read(length)).decode().split("\0")
                    held, rows = block, list(zip(cells[::4], cells[1::4], cells[2::4], cells[3::4]))
                    keys = [r[0] for r in rows]
                wanted += rows[bisect_left(keys, key) : bisect_right(keys, key)]
            wanted.sort(key=lambda r: (r[1], int(r[2])))
            for at in range(0, len(wanted), 500):
                out = []
                for _, name, offset, length in wanted[at : at + 500]:
                    if name != opened:
                        archive_file, opened = system.open_input_file(f"{folder}/archive/{name}"), name
                    archive_file.seek(int(offset))
                    fields, size, payload = parse(archive_file.read(int(length)))
                    number = lambda f: int(fields[f][10:-1]) if fields.get(f, "<urn:page:>")[10:-1] else None  # noqa: B023, E731
                    kind = fields["WARC-Type"]
                    out.append((number("WARC-Record-ID"), size, fields["WARC-Payload-Digest"][5:], kind, number("WARC-Refers-To"), payload if kind == "response" else None))
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in out], t) for i, t in enumerate(types)],
                    ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"],
                )

    keys = urls.select(F.replace(capture_key(F.col("url")), F.lit("\0"), F.lit("")).alias("key")).distinct()
    # a number, as the rows are small but each stands for a record to read: by their size they would meet in few tasks
    tasks = max(1, -(-len(blocks) // BLOCKS_PER_TASK))
    found = keys.mapInArrow(find, "block int, key string").repartition(tasks, "block").sortWithinPartitions("block", "key")
    return found.mapInArrow(read, f"{RECORDS}, payload binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return lookup(spark, write_archive(spark, pages), pages).drop("payload")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (1 + ((('0x' || substr(h, 5 * (i // 4)::INT + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31))::INT, 1) for i in range(32)], '') AS payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > first THEN first END AS refers_to
FROM p
"""
