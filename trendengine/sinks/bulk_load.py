"""Bulk load as files that a warehouse copies in, with one commit per batch.

A data source writer (`BulkLoad`): each task writes one CSV file in the form that ``COPY … (FORMAT csv)`` reads, under a name that no other
attempt uses, and reports its name, rows, bytes and digest. When all tasks are done, the driver publishes the batch by one manifest that lists these
files and nothing else; readers and the warehouse go by manifests. So a failed run publishes nothing, files of repeated tasks are never read, and a
second run of a batch takes the place of the first: its manifest is replaced, then the files of earlier runs are deleted.

``<path>/manifests/<batch>.json``, ``<path>/files/<batch>/<run>/<file>.csv``. The path is one that ``pyarrow.fs`` opens (local, S3, GCS, HDFS). The driver
holds one line per file of a batch.

In the files a null is an empty field, an empty text is ``""``, quotes are doubled, dates and times are ISO in UTC.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "bulk_load"


@dataclass
class Written(WriterCommitMessage):
    """What a task reports of its file."""

    name: str
    rows: int
    size: int
    sha256: str


def _open(path: str):
    """(file system, path below it) of a folder given as URI or absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class _Digested:
    """A stream that keeps the digest and number of the bytes that pass."""

    def __init__(self, out):
        self.out, self.sha, self.size, self.closed = out, hashlib.sha256(), 0, False

    def write(self, data) -> int:
        data = bytes(data)
        self.sha.update(data)
        self.size += len(data)
        self.out.write(data)
        return len(data)

    def writable(self) -> bool:
        return True

    def flush(self) -> None:
        self.out.flush()


class BulkWriter(DataSourceArrowWriter):
    def __init__(self, path: str, batch: str):
        self.path, self.batch, self.run = path, batch, uuid.uuid4().hex

    @property
    def folder(self) -> str:
        return f"files/{self.batch}/{self.run}"

    def write(self, iterator: Iterator) -> Written:
        from pyarrow import csv

        system, root = _open(self.path)
        name, rows = f"{self.folder}/{uuid.uuid4().hex}.csv", 0
        system.create_dir(f"{root}/{self.folder}", recursive=True)
        with system.open_output_stream(f"{root}/{name}") as out:
            file = _Digested(out)
            for batch in iterator:
                csv.write_csv(batch, file, csv.WriteOptions(include_header=False))
                rows += batch.num_rows
        return Written(name, rows, file.size, file.sha.hexdigest())

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _open(self.path)
        files = sorted((asdict(m) for m in messages if m is not None and m.rows), key=lambda f: f["name"])
        listed = {f["name"] for f in files}
        manifest = {"batch": self.batch, "run": self.run, "rows": sum(f["rows"] for f in files), "files": files}
        system.create_dir(f"{root}/manifests", recursive=True)
        draft, final = f"{root}/manifests/.{self.run}", f"{root}/manifests/{self.batch}.json"
        with system.open_output_stream(draft) as out:
            out.write(json.dumps(manifest).encode())
        system.move(draft, final)  # from here on the batch is this run's
        self._clean(system, root, listed)

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        system, root = _open(self.path)
        if system.get_file_info(f"{root}/{self.folder}").type != fs.FileType.NotFound:
            system.delete_dir(f"{root}/{self.folder}")

    def _clean(self, system, root: str, listed: set[str]) -> None:
        """Files of the batch that its manifest does not list: earlier runs, attempts that were repeated."""
        from pyarrow import fs

        chosen = fs.FileSelector(f"{root}/files/{self.batch}", recursive=True, allow_not_found=True)
        for info in system.get_file_info(chosen):
            if info.type == fs.FileType.File and info.path.removeprefix(f"{root}/") not in listed:
                system.delete_file(info.path)


class BulkLoad(DataSource):
    """``df.write.format("bulk_load").mode("append").option("batch", …).save(path)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        raise ValueError("this format is written; read_bulk reads it")

    def writer(self, schema: T.StructType, overwrite: bool) -> BulkWriter:
        batch = self.options.get("batch", "")
        if not batch or "/" in batch:
            raise ValueError("option batch: a name without slashes")
        return BulkWriter(self.options["path"], batch)


def bulk_load(rows: DataFrame, path: str, batch: str) -> None:
    """Load ``rows`` as the content of a batch, in place of what it had."""
    rows.sparkSession.dataSource.register(BulkLoad)
    rows.write.format(FORMAT).mode("append").option("batch", batch).save(path)


def manifests(path: str) -> list[dict]:
    """The manifests of all published batches, by batch."""
    from pyarrow import fs

    system, root = _open(path)
    found = system.get_file_info(fs.FileSelector(f"{root}/manifests", allow_not_found=True))
    names = sorted(i.path for i in found if i.base_name.endswith(".json") and not i.base_name.startswith("."))
    return [json.loads(system.open_input_stream(name).read()) for name in names]


def read_bulk(spark: SparkSession, path: str, schema: T.StructType, batch: str | None = None) -> DataFrame:
    """The rows of one published batch, or of all, as a warehouse that copies them in gets them."""
    files = [f["name"] for m in manifests(path) if batch in (None, m["batch"]) for f in m["files"]]
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    if not files:
        return spark.createDataFrame([], schema)
    # a null and an empty text stay apart, as in COPY
    rows = spark.read.schema(text).options(escape='"', multiLine="true", emptyValue="", nullValue=None).csv([f"{path}/{name}" for name in files])
    return rows.select(*(F.col(f.name).cast(f.dataType) for f in schema))


def copy_statements(path: str, table: str, columns: list[str], batch: str, empty_first: bool = True) -> list[str]:
    """One transaction that copies a published batch into ``schema.table``; a staging table is emptied first, so it may run again."""
    target = ".".join(f'"{part}"' for part in table.replace('"', "").split("."))
    listed = ", ".join(f'"{c}"' for c in columns)
    files = [f["name"] for m in manifests(path) if m["batch"] == batch for f in m["files"]]
    empty = [f"TRUNCATE {target}"] if empty_first else []
    return ["BEGIN", *empty, *(f"COPY {target} ({listed}) FROM '{path}/{name}' (FORMAT csv)" for name in files), "COMMIT"]
