import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from trendengine.schemas import ARTIST_OBJECT_SCHEMA, CLEAN_SCHEMA, DIM_GENRES, TRACK_OBJECT_SCHEMA
from trendengine.sinks import writers as W
from trendengine.sources import batches as B
from trendengine.sources import readers as R

HEADER = "artist,id,genres,location,date,trend_score\n"
STEM = "spotify_rising_with_trends"


def _batch(root, day, name=None, text=HEADER):
    folder = root / day
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / (name or f"{STEM}_{day}.csv")
    path.write_text(text, encoding="utf-8")
    return path


def test_newest_folder_lacks_the_file(spark, tmp_path):
    _batch(tmp_path, "2025_01_01")
    good = _batch(tmp_path, "2025_02_01", name=f"{STEM.upper()}_2025_02_01.CSV")
    _batch(tmp_path, "2025_03_01", name="other.csv")
    _batch(tmp_path, "notes", name=f"{STEM}_2020_01_01.csv")
    root = str(tmp_path)
    assert B.latest_by_file(spark, root)[0].endswith(str(good))
    assert B.latest_with_file(spark, root)[1] == "2025_02_01"
    assert B.latest_by_folder(spark, root) is None
    (tmp_path / "2025_02_01" / "notes").mkdir()
    assert B.batch_folders(spark, root) == ["2025_03_01", "2025_02_01", "2025_01_01"]
    assert B.resolve_input(spark, str(tmp_path))[1] == "2025_02_01"


def test_folder_date_and_file_date_must_agree(spark, tmp_path):
    _batch(tmp_path, "2025_01_01")
    _batch(tmp_path, "2025_02_01", name=f"{STEM}_2025_06_06.csv")
    root = str(tmp_path)
    assert B.latest_by_file(spark, root)[1] == "2025_06_06"
    assert B.latest_with_file(spark, root)[1] == "2025_01_01"
    assert B.latest_by_folder(spark, root) is None


def test_an_empty_newest_folder_and_no_folder_at_all(spark, tmp_path):
    root = str(tmp_path)
    assert B.latest_by_folder(spark, root) is B.latest_with_file(spark, root) is B.latest_by_file(spark, root) is None
    assert B.latest_by_folder(spark, f"{root}/none") is None
    _batch(tmp_path, "2025_01_01")
    assert B.latest_by_folder(spark, root)[1] == "2025_01_01"
    (tmp_path / "2025_02_01").mkdir()
    assert B.latest_by_folder(spark, root) is None and B.latest_with_file(spark, root)[1] == "2025_01_01"


def test_batch_written_by_spark_counts_once(spark, tmp_path):
    rows = spark.range(100).select(*[F.col("id").cast("string").alias(c) for c in R.RAW_SCHEMA.fieldNames()])
    W.write_csv(rows.repartition(3), W.raw_path(str(tmp_path), "2025_05_05"))
    path, day = B.resolve_input(spark, root=str(tmp_path))
    assert day == "2025_05_05" and R.read_raw_csv(spark, path).count() == 100


def test_explicit_path_wins(spark, tmp_path):
    _batch(tmp_path, "2025_01_01")
    assert B.resolve_input(spark, str(tmp_path), f"/x/{STEM}_2019_09_09.csv") == (f"/x/{STEM}_2019_09_09.csv", "2019_09_09")
    with pytest.raises(ValueError):
        B.resolve_input(spark)
    with pytest.raises(ValueError):
        B.resolve_input(spark, override="/x/unnamed.csv")


def test_no_batch_at_all(spark, tmp_path):
    _batch(tmp_path, "2025_01_01", name="other.csv")
    with pytest.raises(FileNotFoundError):
        B.resolve_input(spark, str(tmp_path))


def test_quotes_and_line_breaks(spark, tmp_path):
    path = _batch(
        tmp_path, "2025_01_01",
        text=HEADER + '"D ""x"" y",1,"[""a"", ""b""]",NV,2025-01-01,4\n"two\nlines",2,,,"",5\n',
    )
    rows = R.read_raw_csv(spark, str(path), multi_line=True).collect()
    assert [r["artist"] for r in rows] == ['D "x" y', "two\nlines"]
    assert rows[0]["genres"] == '["a", "b"]'
    assert rows[1]["genres"] is None and rows[1]["date"] is None


def test_csv_round_trip(spark, tmp_path):
    values = [('say "hi"', " padded ", None, "a,b", "x\\y", "'q'")]
    df = spark.createDataFrame(values, R.RAW_SCHEMA)
    path = W.write_csv(df, str(tmp_path / "out"))
    assert [tuple(r) for r in R.read_raw_csv(spark, path).collect()] == values


def test_file_order_follows_the_lines(spark, tmp_path):
    """Two files of several blocks, the last block of each shorter than the others."""
    for name, first in (("a", 0), ("b", 100_000)):
        lines = "".join(f"{name},{first + i},pop,NV,2025-01-01,{'9' * (200 + i % 150)}\n" for i in range(12_000))
        (tmp_path / f"{name}.csv").write_text(HEADER + lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        df = R.with_file_order(R.read_raw_csv(spark, str(tmp_path)))
        assert df.rdd.getNumPartitions() > 4
        rows = df.select("artist", "ingest_seq", F.col("id").cast("int").alias("i")).orderBy("ingest_seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len({r["ingest_seq"] for r in rows}) == 24_000
    assert [r["i"] for r in rows if r["artist"] == "a"] == list(range(12_000))
    assert [r["i"] for r in rows if r["artist"] == "b"] == list(range(100_000, 112_000))


def test_json_sources(spark, tmp_path):
    listed = [{"artist": "A", "id": "1", "genres": ["x"]}, {"artist": "B", "id": "2"}]
    whole = tmp_path / "list.json"
    whole.write_text(json.dumps(listed, indent=2))
    rows = R.read_json_array(spark, str(whole)).collect()
    assert [(r["artist"], r["genres"]) for r in rows] == [("A", ["x"]), ("B", None)]

    root = tmp_path / "artists"
    leaf = root / "genre=house" / "market=US"
    leaf.mkdir(parents=True)
    (leaf / "artists.json").write_text(json.dumps([{"id": "1", "name": "A", "popularity": 3, "followers": {"total": 9}}]))
    row = R.read_search_results(spark, str(root), ARTIST_OBJECT_SCHEMA).head()
    assert (row["genre"], row["market"], row["popularity"], row["followers"]["total"]) == ("house", "US", 3, 9)

    tracks = tmp_path / "tracks" / "genre=house" / "market=US"
    tracks.mkdir(parents=True)
    (tracks / "tracks.json").write_text(json.dumps([{"id": "t", "artists": [{"id": "1", "name": "A"}], "explicit": False}]))
    row = R.read_search_results(spark, str(tmp_path / "tracks"), TRACK_OBJECT_SCHEMA).head()
    assert row["artists"][0]["name"] == "A" and row["explicit"] is False


def test_missing_dimension_is_empty(spark, tmp_path):
    df = R.read_dim(spark, str(tmp_path / "none"), DIM_GENRES)
    assert df.count() == 0 and df.columns == ["genre_id", "genre"]


def test_partitioned_write_and_pruned_read(spark, tmp_path, clean_frame):
    rows = [("A", str(i), "pop", "NV", dt.date(2025, 1 + i % 3, 1 + i % 28), float(i)) for i in range(60)]
    for files in (None, 2):
        path = W.write_partitioned(clean_frame(*rows), str(tmp_path), "2025_03_31", files)
        back = R.read_cleaned(spark, path)
        assert sorted(tuple(r)[:6] for r in back.collect()) == sorted(rows)
        assert [f.dataType for f in CLEAN_SCHEMA] == [back.schema[c].dataType for c in CLEAN_SCHEMA.fieldNames()]
    span = R.read_cleaned(spark, path, dt.date(2025, 2, 3), dt.date(2025, 2, 20))
    plan = span._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in filters and "month" in filters
    assert "GreaterThanOrEqual(date" in plan
    assert span.count() == sum(dt.date(2025, 2, 3) <= r[4] <= dt.date(2025, 2, 20) for r in rows)
    files_read = {r[0] for r in span.select(F.input_file_name()).distinct().collect()}
    assert all("month=2" in f for f in files_read)


def test_overwriting_a_batch_removes_its_old_months(spark, tmp_path, clean_frame):
    W.write_partitioned(clean_frame(("A", "1", "pop", "NV", dt.date(2025, 1, 1), 1.0)), str(tmp_path), "d")
    path = W.write_partitioned(clean_frame(("A", "1", "pop", "NV", dt.date(2025, 2, 1), 1.0)), str(tmp_path), "d")
    assert [r["month"] for r in R.read_cleaned(spark, path).collect()] == [2]


def test_salted_write_spreads_one_month(spark, tmp_path, clean_frame):
    rows = [("A", str(i), "pop", "NV", dt.date(2025, 1, 1 + i % 28), 1.0) for i in range(400)]
    setting = "spark.sql.adaptive.coalescePartitions.enabled"  # would join files this small
    spark.conf.set(setting, "false")
    try:
        path = W.write_partitioned(clean_frame(*rows), str(tmp_path), "d", files_per_month=8)
    finally:
        spark.conf.set(setting, "true")
    assert len(list((tmp_path / "d").rglob("*.parquet"))) > 1
    assert R.read_cleaned(spark, path).count() == len(rows)


def test_artist_list_to_csv(spark, tmp_path):
    df = spark.createDataFrame([("A", ["x", "y"]), ("B", None)], "artist string, genres array<string>")
    path = W.artists_to_csv(df, str(tmp_path / "out"))
    rows = spark.read.options(**R.CSV_OPTIONS).csv(path).collect()
    assert {(r["artist"], r["genres"]) for r in rows} == {("A", "x; y"), ("B", None)}
    with pytest.raises(ValueError):
        W.artists_to_csv(df.limit(0), str(tmp_path / "none"))


def test_staging_statements():
    text = W.staging_ddl("staging.artist_trends")
    assert text.count("CREATE INDEX IF NOT EXISTS") == 3 and text.startswith('CREATE SCHEMA IF NOT EXISTS "staging"')
    assert 'CREATE TABLE IF NOT EXISTS "staging"."artist_trends"' in text and "CHAR(2)" in text
    assert '"public"."t"' in W.staging_ddl("t")


def test_enriched_lines_land_as_a_raw_batch(spark, tmp_path):
    lines = tmp_path / "lines.jsonl"
    lines.write_text('{"artist": "A", "id": "1", "genres": ["x", "y"], "daily_trends_NV_2025-01-02": 5}\n\n')
    path = W.land_enriched_batch(spark, str(lines), str(tmp_path / "raw"), "2025_01_03")
    assert B.resolve_input(spark, root=str(tmp_path / "raw"))[1] == "2025_01_03"
    assert [tuple(r) for r in R.read_raw_csv(spark, path).collect()] == [("A", "1", "x; y", "NV", "2025-01-02", "5.0")]
    lines.write_text("")
    path = W.land_enriched_batch(spark, str(lines), str(tmp_path / "raw"), "2025_01_04")
    assert [p.read_text().strip() for p in (tmp_path / "raw" / "2025_01_04").rglob("part*.csv")] == [HEADER.strip()]
    assert R.read_raw_csv(spark, path).count() == 0


def test_object_store_key(spark, monkeypatch):
    from trendengine.session import set_object_store_key

    monkeypatch.delenv("AZURE_STORAGE_ACCOUNT", raising=False)
    assert not set_object_store_key(spark)
    with pytest.raises(RuntimeError):
        set_object_store_key(spark, required=True)
    monkeypatch.setenv("AZURE_STORAGE_ACCOUNT", "acct")
    monkeypatch.setenv("AZURE_STORAGE_KEY", "k3y")
    assert set_object_store_key(spark)
    assert spark.conf.get("fs.azure.account.key.acct.blob.core.windows.net") == "k3y"


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace as N

    from trendengine.session import shared_dir

    def session(master, **settings):
        conf = N(get=lambda key, default=None: settings.get(key, default), set=settings.__setitem__)
        return N(conf=conf, sparkContext=N(master=master, getConf=lambda: conf))

    with pytest.raises(RuntimeError):
        shared_dir(session("spark://host:7077"))
    with pytest.raises(RuntimeError):
        shared_dir(session("local-cluster[3,2,1000]"))
    assert shared_dir(session("yarn", **{"spark.checkpoint.dir": "hdfs:///x/"})) == "hdfs:///x"
    local = session("local[4]")
    assert shared_dir(local) == shared_dir(local)


def test_documents_follow_the_records_of_a_folder(spark, tmp_path):
    """Four folders take turns, one of them has no name; a folder of 50 records has files for 10 each, not one per folder and run of 10."""
    from trendengine.plans.queries import _write_documents

    genres = ["pop", "rock", None, "edm"]
    rows = [(n, str(n), genres[n % 4], "US" if n % 4 else None) for n in range(200)] + [(7, "7", "edm", "US"), (201, "201", "jazz", "US")]
    found = spark.createDataFrame(rows, "ingest_seq long, id string, genre string, market string")
    _write_documents(found, F.struct("id"), ["genre", "market"], str(tmp_path / "named"), size=10)
    assert len(list(tmp_path.glob("named/**/*.txt"))) <= 4 * 5 + 2
    read = R.read_search_results(spark, str(tmp_path / "named"), ARTIST_OBJECT_SCHEMA).select("id", "genre", "market")
    assert sorted(map(tuple, read.collect()), key=str) == sorted((r[1:] for r in rows), key=str)
    _write_documents(found, F.struct("id"), [], str(tmp_path / "plain"), size=10)
    assert len(list(tmp_path.glob("plain/**/*.txt"))) <= 21
    assert sorted(r.id for r in spark.read.schema("id string").option("multiLine", True).json(str(tmp_path / "plain")).collect()) == sorted(r[1] for r in rows)
