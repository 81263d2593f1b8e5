"""Streams over the event log, run until all input is read and then returned as tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintwell.operators.relational import latest
from tintwell.operators.scratch import root
from tintwell.plans.registry import query
from tintwell.streaming import events as log


def _stream(spark: SparkSession, d: str) -> DataFrame:
    """The events table as a stream; a pattern, as a stream's path may be a folder or a pattern but no file."""
    known = spark.read.parquet(f"{d}/events.parquet").schema
    return spark.readStream.schema(known).parquet(f"{d}/events.parque[t]").withColumn("ts", F.col("ts").cast("timestamp"))


def drained(stream: DataFrame, mode: str) -> DataFrame:
    """All rows that the stream gives for the input there is, with the number of their batch."""
    spark = stream.sparkSession
    at = f"{root(spark)}/{spark.sparkContext.applicationId}/stream-{uuid.uuid4().hex}"

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{at}/out/part={number}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/state").foreachBatch(write).trigger(availableNow=True).start().awaitTermination()
    return spark.read.option("basePath", f"{at}/out").parquet(f"{at}/out").drop("part")


@query("SELECT CAST(user_id AS VARCHAR) AS item_id, event_type AS kind, CAST(event_id AS VARCHAR) AS event_id, CAST(value AS VARCHAR) AS value FROM events WHERE event_id % 13 <> 0 QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) = 1")
def stream_latest_live(spark: SparkSession, d: str) -> DataFrame:
    """Latest event of each key that no revocation names, kept as state; every 13th event is taken back."""
    e = _stream(spark, d)
    one = F.struct(F.lit(None).cast("string").alias("revokes_event_id"))
    back = F.struct(F.col("event_id").cast("string").alias("revokes_event_id"))
    rows = e.select(F.col("event_id").cast("string").alias("event_id"), F.col("user_id").cast("string").alias("item_id"), F.col("event_type").alias("kind"), F.col("value").cast("string").alias("value"), F.col("ts").alias("created_at"), F.inline(F.array_compact(F.array(one, F.when(F.col("event_id") % 13 == 0, back)))))
    out = latest(drained(log.latest_live(rows), "update"), ["item_id", "kind"], ["batch"])
    return out.where("event_id IS NOT NULL").select("item_id", "kind", "event_id", "value")


@query("SELECT * FROM (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2) WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR")
def stream_windowed_counts(spark: SparkSession, d: str) -> DataFrame:
    """Events by hour and kind, for the hours that the watermark has closed."""
    return drained(log.windowed_counts(_stream(spark, d)), "append").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


__all__ = ["drained", "stream_latest_live", "stream_windowed_counts"]
