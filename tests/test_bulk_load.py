"""Bulk load: what a manifest lists is what is read, after repeated, failed and empty runs."""

import datetime as dt
import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from trendengine.plans import batch, job
from trendengine.sinks import bulk_load as B
from trendengine.sinks import writers as W

SCHEMA = "i int, s string, t string, d date, f double, ts timestamp"
ROWS = [(1, None, 'a"b', dt.date(2024, 1, 1), 1.5, dt.datetime(2024, 1, 1, 2, 3, 4)), (2, "", "x,y\nz é", None, None, None), (3, "\\N", "'", dt.date(1999, 12, 31), -0.1, None)]


def read(spark, path, schema, name=None):
    return sorted(tuple(r) for r in B.read_bulk(spark, path, schema, name).collect())


def files(tmp_path):
    return {str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*") if p.is_file() and not p.name.startswith(".")}


def test_rows_come_back_and_a_second_run_replaces(spark, tmp_path):
    rows, path = spark.createDataFrame(ROWS, SCHEMA).repartition(3), str(tmp_path)
    B.bulk_load(rows, path, "a")
    B.bulk_load(rows.where("i < 3"), path, "b")
    first = files(tmp_path)
    B.bulk_load(rows, path, "a")
    assert read(spark, path, rows.schema, "a") == ROWS and read(spark, path, rows.schema, "b") == ROWS[:2]
    assert len(B.read_bulk(spark, path, rows.schema).collect()) == 5
    listed = {f["name"] for m in B.manifests(path) for f in m["files"]}
    assert files(tmp_path) == listed | {"manifests/a.json", "manifests/b.json"} and first != files(tmp_path)
    for m in B.manifests(path):
        for f in m["files"]:
            blob = (tmp_path / f["name"]).read_bytes()
            assert (f["size"], f["sha256"]) == (len(blob), hashlib.sha256(blob).hexdigest())


def test_a_failed_run_publishes_nothing_and_leaves_nothing(spark, tmp_path):
    rows, path = spark.createDataFrame([(i,) for i in range(100)], "i long").repartition(4), str(tmp_path)
    B.bulk_load(rows.where("i < 50"), path, "a")
    before = files(tmp_path)
    broken = rows.withColumn("i", F.when(F.col("i") == 77, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("i")))
    with pytest.raises(PySparkException):
        B.bulk_load(broken, path, "a")
    assert files(tmp_path) == before and [r[0] for r in read(spark, path, rows.schema)] == list(range(50))
    B.bulk_load(rows, path, "a")
    assert [r[0] for r in read(spark, path, rows.schema)] == list(range(100))


def test_files_of_repeated_attempts_are_not_read(spark, tmp_path):
    """Two attempts of one task write, one is committed."""
    import pyarrow as pa

    writer = B.BulkWriter(str(tmp_path), "a")
    part = [pa.RecordBatch.from_pydict({"i": [1, 2]})]
    lost, kept = writer.write(iter(part)), writer.write(iter(part))
    assert lost.name != kept.name and len(files(tmp_path)) == 2
    writer.commit([kept, None])
    assert [r[0] for r in read(spark, str(tmp_path), spark.createDataFrame([], "i long").schema)] == [1, 2]
    assert files(tmp_path) == {kept.name, "manifests/a.json"}
    writer.abort([])  # of a run that never wrote
    B.BulkWriter(str(tmp_path), "b").abort([])


def test_empty_batches_names_and_statements(spark, tmp_path):
    rows, path = spark.createDataFrame(ROWS, SCHEMA), str(tmp_path)
    assert B.read_bulk(spark, path, rows.schema).count() == 0
    B.bulk_load(rows, path, "a")
    B.bulk_load(rows.where("false"), path, "a")
    assert B.read_bulk(spark, path, rows.schema).count() == 0 and B.manifests(path)[0]["rows"] == 0
    for name in ("", "x/y"):
        with pytest.raises(PySparkException):
            B.bulk_load(rows, path, name)
    B.bulk_load(rows, path, "a")
    found = B.copy_statements(path, "w.t", ["i", "s"], "a")
    assert found[:2] == ["BEGIN", 'TRUNCATE "w"."t"'] and found[-1] == "COMMIT" and len(found) == 3 + len(B.manifests(path)[0]["files"])
    assert found[2].startswith('COPY "w"."t" ("i", "s") FROM') and "TRUNCATE" not in "".join(B.copy_statements(path, "t", ["i"], "a", empty_first=False))


def test_the_job_publishes_the_newest_batch(spark, tmp_path, raw_frame, monkeypatch):
    W.write_csv(raw_frame(("A", "1", "pop|rock", "nv", "2025-01-01", "5")), W.raw_path(str(tmp_path / "in"), "2025_01_02"))
    for name, folder in (("RAW_ROOT", "in"), ("TRANSFORM_ROOT", "out"), ("STAGING_COPY_PATH", "copy")):
        monkeypatch.setenv(name, str(tmp_path / folder))
    monkeypatch.delenv("DIMS_ROOT", raising=False)
    for _ in range(2):
        job.main()
    assert [(m["batch"], m["rows"]) for m in B.manifests(str(tmp_path / "copy"))] == [("2025_01_02", 2)]
    assert batch.load_batch_files(spark, str(tmp_path / "out"), str(tmp_path / "copy")) == "2025_01_02"
