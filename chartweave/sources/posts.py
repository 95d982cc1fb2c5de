"""Posts with chart images as a table or a stream, and the files to fetch from them."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from chartweave.functions.dates import announced_date, posted_at

# fixed value: older posts hold no charts
CUTOFF = "2023-08-10"


def recent_posts(posts: DataFrame, cutoff: str = CUTOFF) -> DataFrame:
    """posts with posted (timestamp) and chart_date, from the cutoff on; those whose time can't be read are left out."""
    p = posts.withColumn("posted", posted_at(F.col("created_at"))).filter(F.col("posted") >= F.lit(cutoff).cast("timestamp"))
    return p.withColumn("chart_date", announced_date(F.col("full_text")))


def target_name(chart_date: Column, posted: Column, place: Column) -> Column:
    """File name of an image: date of the chart, else of the post, and its place in the post from 1."""
    return F.concat_ws("", F.date_format(F.coalesce(chart_date, F.to_date(posted)), "yyyy-MM-dd"), F.lit("_"), place, F.lit(".jpg"))


def image_files(posts: DataFrame, cutoff: str = CUTOFF) -> DataFrame:
    """(id, posted, chart_date, url, file_name) of each photo with an address; places count all media."""
    media = recent_posts(posts, cutoff).select("id", "posted", "chart_date", F.posexplode("media").alias("at", "m"))
    photos = media.filter((F.col("m.type") == "photo") & F.col("m.url").isNotNull())
    name = target_name(F.col("chart_date"), F.col("posted"), (F.col("at") + 1).cast("string"))
    return photos.select("id", "posted", "chart_date", F.col("m.url").alias("url"), name.alias("file_name"))


def new_files(files: DataFrame, present: DataFrame) -> DataFrame:
    """files not yet present (file_name), one per name: that of the earliest post."""
    first = files.groupBy("file_name").agg(F.min_by(F.struct("id", "posted", "chart_date", "url"), F.struct("posted", "id", "url")).alias("f"))
    return first.select("f.*", "file_name").join(present.select("file_name"), "file_name", "left_anti")


def next_cursor(posts: DataFrame) -> DataFrame:
    """One row: the newest and the oldest time read and the id of the oldest post, from which a backward search goes on."""
    p = recent_posts(posts)
    return p.agg(F.max("posted").alias("newest"), F.min("posted").alias("oldest"), F.min_by("id", F.struct("posted", "id")).alias("oldest_id"))


class PostSource(DataSource):
    """Python data source 'posts': lines of JSON posts in a file that all executors see, in pages of option `page` lines (100) as a stream,
    of `bytes` (4 MB) as a batch.

    A page begins at a byte of the file, so no line is read twice. The stream's offset is the byte read up to; a
    restarted query goes on where its checkpoint ends, and a line without its end waits until it is whole.
    """

    @classmethod
    def name(cls) -> str:
        return "posts"

    def schema(self) -> str:
        return "id string, created_at string, full_text string, media array<struct<type:string,url:string>>"

    def reader(self, schema) -> DataSourceReader:
        return _PostReader(self.options)

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _PostStream(self.options)


def _post(line: bytes) -> tuple:
    import json

    p = json.loads(line)
    media = p.get("media")
    return p.get("id"), p.get("created_at"), p.get("full_text"), None if media is None else [(m.get("type"), m.get("url")) for m in media]


def _posts(path: str, start: int, end: int) -> Iterator[tuple]:
    """The posts of the lines that begin in start..end."""
    with open(path, "rb") as f:
        if start:
            f.seek(start - 1)
            f.readline()
        while f.tell() < end and (line := f.readline()):
            if line.strip():
                yield _post(line)


class _PostReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.size = options["path"], int(options.get("bytes", 4_000_000))

    def partitions(self) -> list[InputPartition]:
        import os

        return [InputPartition(i) for i in range(0, max(os.path.getsize(self.path), 1), self.size)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return _posts(self.path, partition.value, partition.value + self.size)


class _PostStream(SimpleDataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.path, self.page = options["path"], int(options.get("page", 100))

    def initialOffset(self) -> dict:
        return {"byte": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, at = [], start["byte"]
        with open(self.path, "rb") as f:
            f.seek(at)
            while len(rows) < self.page and (line := f.readline()).endswith(b"\n"):
                at += len(line)
                if line.strip():
                    rows.append(_post(line))
        return iter(rows), {"byte": at}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return _posts(self.path, start["byte"], end["byte"])

    def commit(self, end: dict) -> None:
        pass


def register(spark: SparkSession) -> None:
    """Makes the format 'posts' known to the session."""
    spark.dataSource.register(PostSource)
