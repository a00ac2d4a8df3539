"""Stream sources and sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_stream(spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None,
                files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files as they arrive; the oldest first."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


# Event time of a closing row: later than any real one, so the watermark passes every open window.
END_OF_STREAM = "9000-01-01 00:00:00"


def closable(stream: DataFrame, path: str) -> DataFrame:
    """``stream`` that ends when ``close_stream`` has written its row to ``path``."""
    return stream.unionByName(stream.sparkSession.readStream.schema(stream.schema).parquet(path))


def close_stream(spark: SparkSession, schema: T.StructType, ts: str, path: str) -> None:
    """Writes the closing row: the next run emits all open windows and runs, once; rows that come later are too late."""
    end = F.lit(END_OF_STREAM).cast(schema[ts].dataType)
    values = [end.alias(f.name) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    spark.range(1).select(*values).coalesce(1).write.mode("append").parquet(path)


def open_for_closing(spark: SparkSession, schema: T.StructType, path: str) -> str:
    """The empty folder that a closing row will go to."""
    spark.createDataFrame([], schema).write.mode("append").parquet(path)
    return path


def kept(df: DataFrame, ts: str, condition: Column) -> DataFrame:
    """Rows that meet the condition, and the closing row, which ``event_time`` must see.

    Goes before ``event_time``: Spark moves filters on other columns there in any case.
    """
    return df.filter(condition | (F.col(ts) >= F.lit(END_OF_STREAM).cast(df.schema[ts].dataType)))


def event_time(df: DataFrame, ts: str, delay: str = "30 minutes") -> DataFrame:
    """Watermarks need a TIMESTAMP, so the naive time is cast; only in UTC does no clock change move it.

    A closing row moves the watermark and goes no further.
    """
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"streams over naive times need the session time zone UTC, not {zone}")
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return timed.filter(F.col(ts).isNull() | (F.col(ts) < F.lit(END_OF_STREAM).cast("timestamp")))


def append_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Runs everything available into a Parquet table (exactly once) and waits.

    ``checkpoint`` belongs to the table: a later run with the same one adds what is new.
    """
    query = (stream.writeStream.outputMode("append").format("parquet").option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def each_batch(stream: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str,
               mode: str = "append") -> None:
    """Runs everything available through ``action`` and waits; batch numbers go on from the checkpoint's."""
    query = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
             .foreachBatch(action).trigger(availableNow=True).start())
    query.awaitTermination()


def snapshots_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Keeps the complete result of every micro-batch as one partition.

    A repeated batch replaces its own partition, so a restart leaves no duplicates.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    each_batch(stream, write, checkpoint, "complete")


def upserts_to_table(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], compact_every: int = 16) -> None:
    """Keeps the newest row per key of a stream in update mode; ``newest_rows`` reads the table.

    A micro-batch adds the rows it changed and no others. Every ``compact_every``-th one writes all newest rows
    instead, after which what is older than the base before it is deleted. A repeated batch replaces its own
    folder; a base is made of older folders only, and those stay until the next one, so a restart at any point
    loses nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id % compact_every != compact_every - 1:
            batch.write.mode("overwrite").parquet(f"{path}/kind=change/batch_id={batch_id}")
            return
        stored = batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
        if batch_id > 0:
            stored = _stored(batch.sparkSession, path, batch.schema, batch_id).drop("kind").unionByName(stored)
        base = _newest(stored, keys, batch.columns)
        base.write.mode("overwrite").parquet(f"{path}/kind=base/batch_id={batch_id}")
        _delete_older(batch.sparkSession, path, batch_id)

    each_batch(stream, write, checkpoint, "update")


def _stored(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """Rows of the newest base and of the changes after it, of batches before ``before`` only."""
    places = [T.StructField("kind", T.StringType()), T.StructField("batch_id", T.LongType())]
    rows = spark.read.schema(T.StructType([*schema.fields, *places])).parquet(path)
    if before is not None:
        rows = rows.filter(F.col("batch_id") < before)
    newest_base = rows.filter("kind = 'base'").agg(F.coalesce(F.max("batch_id"), F.lit(-1))).scalar()
    return rows.filter(F.col("batch_id") >= newest_base)


def _newest(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    row = F.max_by(F.struct(*columns), "batch_id").alias("_row")
    return rows.groupBy(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)]).agg(row).select("_row.*")


def _delete_older(spark: SparkSession, path: str, batch_id: int) -> None:
    """Deletes the folders of batches older than the base before ``batch_id``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    # Two bases at most, and the changes since the older one.
    found = []
    for kind in ("base", "change"):
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/kind={kind}")
        files = folder.getFileSystem(conf)
        for entry in files.listStatus(folder) if files.exists(folder) else []:
            found.append((kind, int(entry.getPath().getName().split("=")[1]), files, entry.getPath()))
    previous = max((number for kind, number, _, _ in found if kind == "base" and number < batch_id), default=0)
    for _, number, files, folder in found:
        if number < previous:
            files.delete(folder, True)


def newest_rows(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The table of ``upserts_to_table``: one row per key, as the last batch that changed it left it."""
    return _newest(_stored(spark, path, schema), keys, schema.fieldNames())


def newest_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    kept = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])).parquet(path)
    return kept.filter(F.col("batch_id") == kept.agg(F.max("batch_id").alias("b")).scalar()).drop("batch_id")
