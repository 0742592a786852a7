"""Structured Streaming over event logs and inboxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from loomery import schema


def freeze_events(spark: SparkSession, path: str) -> DataFrame:
    """The freeze log as a stream of new files, with an event time."""
    return spark.readStream.schema(schema.FREEZE_EVENT).json(path).withColumn("event_time", F.to_timestamp("at"))


def windowed_counts(events: DataFrame, time: str, kind: str, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events per window and kind; state older than the watermark is let go."""
    return events.withWatermark(time, late).groupBy(F.window(time, window), kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), kind, "n")


def ingest_new(inbox: DataFrame, target: str, checkpoint: str, key: str = "record_id") -> StreamingQuery:
    """Append rows whose key isn't in ``target`` yet; a batch that runs again adds nothing twice."""

    def batch(rows: DataFrame, _: int) -> None:
        new = rows.dropDuplicates([key])
        try:
            have = rows.sparkSession.read.parquet(target).select(key)
        except Exception as e:  # the first batch finds no table
            if "PATH_NOT_FOUND" not in str(e):
                raise
        else:
            new = new.join(have, key, "left_anti")
        new.write.mode("append").parquet(target)

    return inbox.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
