"""Work that can be taken up again: incremental appends and streaming file lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chartweave.sources.posts import image_files


def append_new(batch: DataFrame, path: str, key: str) -> None:
    """Appends the rows of batch whose key isn't in the table at path yet; repeated runs change nothing."""
    spark = batch.sparkSession
    rows = batch.dropDuplicates([key])
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        rows = rows.join(spark.read.schema(batch.schema).parquet(path).select(key), key, "left_anti")
    rows.write.mode("append").parquet(path)


def stream_images(posts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Starts appending the image files of a stream of posts to the table at path, each name once.

    Offsets live in the checkpoint, so a restarted query also sees posts newer than those read before.
    """
    files = image_files(posts)
    return files.writeStream.foreachBatch(lambda b, _: append_new(b, path, "file_name")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, late: str = "10 minutes", width: str = "1 hour", by: str = "event_type") -> DataFrame:
    """Counts and sums per window and kind of a stream (or table) of events with a watermark for late rows."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), by, "n", "total")
