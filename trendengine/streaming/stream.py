"""New raw files as a stream, through the same functions as a batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendengine.operators.clean import clean
from trendengine.operators.dedup import dedup_trends, keep_first
from trendengine.operators.explode import explode_genres
from trendengine.plans import batch
from trendengine.schemas import CLEAN_SCHEMA, GRAIN, RAW_SCHEMA
from trendengine.session import remove_folder
from trendengine.sinks.writers import add_partition_cols
from trendengine.sources.batches import folder_names
from trendengine.sources.readers import CSV_OPTIONS, with_file_order


def read_raw_stream(
    spark: SparkSession, pattern: str, schema: T.StructType = RAW_SCHEMA, files_per_trigger: int | None = None
) -> DataFrame:
    """Raw rows of all files that match, each file once.

    The file source by default passes over files a week older than the newest one, i.e. late copies that keep their
    time stamps; the limit is set beyond any real age.
    """
    reader = spark.readStream.schema(schema).options(**CSV_OPTIONS).option("maxFileAge", "36500d")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(pattern)


def clean_stream(raw: DataFrame) -> DataFrame:
    """Clean rows, one per genre; stateless, so nothing has to be kept between triggers."""
    return explode_genres(clean(raw))


def append_parquet(stream: DataFrame, path: str, checkpoint: str, partitioned: bool = True):
    """Take in what has arrived, then stop. The file sink's log makes each file count once."""
    rows = add_partition_cols(stream) if partitioned else stream
    writer = rows.writeStream.format("parquet").outputMode("append")
    if partitioned:
        writer = writer.partitionBy("year", "month")
    query = (
        writer.option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_batches(raw: DataFrame, take: Callable[[DataFrame, int], None], checkpoint: str):
    """Hand each micro-batch that has arrived to ``take``, then stop."""
    query = (
        raw.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def refresh_stream(raw: DataFrame, out_root: str, dims_root: str, checkpoint: str):
    """Cleaned rows, counts and dimensions, brought up to date per micro-batch.

    A micro-batch may come twice after a failure. Its rows and counts have a folder of their own,
    which is written anew, and dimensions only take in keys they lack.
    """

    def take(rows: DataFrame, number: int) -> None:
        spark, part = rows.sparkSession, f"batch_id={number}"
        cleaned, counts = batch.observed_trends(with_file_order(rows))
        cleaned.write.mode("overwrite").parquet(f"{out_root}/rows/{part}")
        summary = spark.createDataFrame([counts()])
        summary.write.mode("overwrite").parquet(f"{out_root}/counts/{part}")
        stored = spark.read.parquet(f"{out_root}/rows/{part}")
        batch.refresh_dims(spark, stored, dims_root)

    return run_batches(raw, take, checkpoint)


#: What `land_unique` writes and `dedup_landed` reads.
LANDED_SCHEMA = T.StructType([*CLEAN_SCHEMA.fields, T.StructField("batch_id", T.LongType())])
KEYS = [*GRAIN[:-1], "event_time"]


def land_unique(raw: DataFrame, out_root: str, checkpoint: str):
    """Clean rows of each micro-batch, one per key, as ``<out_root>/arrived/batch_id=<n>``: text is parsed once, here.

    A micro-batch that comes twice after a failure writes its folder anew.
    """

    def take(rows: DataFrame, number: int) -> None:
        unique = dedup_trends(batch.clean_trends(with_file_order(rows)))
        unique.select(*CLEAN_SCHEMA.fieldNames()).write.mode("overwrite").parquet(f"{out_root}/arrived/batch_id={number}")

    return run_batches(raw, take, checkpoint)


def new_keys(landed: DataFrame, delay: str) -> DataFrame:
    """Keys of a stream at their first arrival, from keyed state that forgets keys older than the watermark.

    Rows later than the watermark do not come out, whether their key is new or not.
    """
    timed = landed.withColumn("event_time", F.col("date").cast("timestamp"))
    return timed.withWatermark("event_time", delay).select(*KEYS).dropDuplicates(KEYS)


def stored_rows(spark: SparkSession, out_root: str, number: int, months: list[tuple[int, int]]) -> DataFrame | None:
    """Keys on record in some months, without those of micro-batch ``number`` itself; none while nothing is stored."""
    if not folder_names(spark, f"{out_root}/rows"):
        return None
    touched = F.lit(False)
    for year, month in months:
        touched = touched | ((F.col("year") == year) & (F.col("month") == month))
    return spark.read.parquet(f"{out_root}/rows").where((F.col("batch_id") != number) & touched).select(*GRAIN)


def dedup_landed(spark: SparkSession, out_root: str, checkpoint: str, delay: str, files_per_trigger: int | None = None):
    """Rows of ``<out_root>/arrived`` whose key arrives for the first time, into ``<out_root>/rows``.

    Keyed state knows every key of the days down to the watermark, so a micro-batch is judged without a look at stored rows. What the
    watermark lets go, rows older than the newest day before them less ``delay``, is late: those alone are compared with the rows on record in their
    months. Nothing is lost for being late, and where nothing is, the cost of a micro-batch does not depend on what is stored.

    The state's answer and the rows are written once per micro-batch; all that follows reads that table, as a plan with state must not run twice.
    """
    reader = spark.readStream.schema(LANDED_SCHEMA).option("maxFileAge", "36500d").option("basePath", f"{out_root}/arrived")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    landed = reader.parquet(f"{out_root}/arrived")
    first = new_keys(landed, delay).withColumn("date", F.col("event_time").cast("date")).withColumn("known", F.lit(False))
    both = first.drop("event_time").unionByName(landed.withColumn("known", F.lit(None).cast("boolean")), allowMissingColumns=True)

    def take(rows: DataFrame, number: int) -> None:
        session, part = rows.sparkSession, f"batch_id={number}"
        judged = f"{out_root}/judged/{part}"
        rows.write.mode("overwrite").parquet(judged)
        rows = session.read.schema(rows.schema).parquet(judged)
        fresh_keys = rows.where("NOT known").select(*GRAIN)
        arrived = keep_first(rows.where("known IS NULL").drop("known"), GRAIN, "batch_id").drop("batch_id")
        newest, low = arrived.agg(F.max("date"), F.min("date")).first()
        if newest is None:
            return
        # Spark lets go what is not after its watermark, and that lags behind this one, so all of it is looked at
        mark = _newest(session, out_root, number, newest, delay)
        fresh = arrived.join(fresh_keys, GRAIN, "left_semi")
        if low <= mark:
            late = arrived.where(F.col("date") <= F.lit(mark)).join(fresh_keys, GRAIN, "left_anti")
            months = late.select(F.year("date").alias("y"), F.month("date").alias("m")).distinct()
            months = [tuple(r) for r in months.collect()]  # as many as the calendar has
            known = stored_rows(session, out_root, number, months) if months else None
            fresh = fresh.unionByName(late if known is None else late.join(known, GRAIN, "left_anti")) if months else fresh
        add_partition_cols(fresh).write.mode("overwrite").partitionBy("year", "month").parquet(f"{out_root}/rows/{part}")
        remove_folder(session, judged)

    return run_batches(both, take, checkpoint)


def _newest(spark: SparkSession, out_root: str, number: int, day, delay: str):
    """The newest day up to a micro-batch, less ``delay``. Each micro-batch leaves its own newest day."""
    marks = f"{out_root}/newest"
    spark.createDataFrame([(day,)], "date date").write.mode("overwrite").parquet(f"{marks}/batch_id={number}")
    past = spark.read.parquet(marks).where(F.col("batch_id") <= number)
    return past.agg((F.max("date").cast("timestamp") - F.expr(f"INTERVAL {delay}")).cast("date")).first()[0]


def dedup_stream(raw: DataFrame, out_root: str, checkpoint: str, delay: str = "31 days", files_per_trigger: int | None = None):
    """Clean rows, one per (id, genres, location, date); of several the first to arrive stays. Nothing is dropped for being late.

    Two streams: `land_unique` reduces what arrived to its keys, `dedup_landed` tells new keys from known ones by keyed state, and late
    rows by the months on record. A micro-batch that comes twice after a failure writes its folders anew and does not count its own
    earlier rows as known.
    """
    land_unique(raw, out_root, f"{checkpoint}/landed")
    return dedup_landed(raw.sparkSession, out_root, f"{checkpoint}/unique", delay, files_per_trigger)
