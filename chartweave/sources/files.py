"""Reading chart tables, images and word boxes; writing results."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartweave.functions.dates import month_folder
from chartweave.schema import WORDS, raw_schema

# fixed value: name of the merged file, which is no input
MERGED = "final_merged_all_dates.csv"
# fixed values: names of dated images
IMAGE = r"^(\d{4}-\d{2}-\d{2})_\d+\.jpg"
DATED_IMAGE = r"(?i)^(\d{4})-(\d{2})-(\d{2})_\d+\.(jpg|jpeg|png)$"


def read_charts(spark: SparkSession, path: str, mbid: bool = False) -> DataFrame:
    """All csv files of a folder but the merged one, every cell a string, with src_file and pos (place in its file, from 0).

    Files without rows are skipped by Spark; the order of files is that of their names, to be sorted by (src_file, pos).
    A file is read by one task, so its rows come in their order; one shuffle by file numbers them.
    """
    df = spark.read.schema(raw_schema(mbid)).option("header", True).option("nullValue", "").option("pathGlobFilter", "*.csv").option("multiLine", True).option("escape", '"').csv(path)
    df = df.select("*", F.col("_metadata.file_name").alias("src_file"), F.col("_metadata.file_path").alias("__path")).filter(F.col("src_file") != MERGED)
    within = Window.partitionBy("__path").orderBy("__at")
    return df.withColumn("__at", F.monotonically_increasing_id()).withColumn("pos", (F.row_number().over(within) - 1).cast("bigint")).drop("__path", "__at")


def read_images(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """(path, file_name, folder, chart_date) of the dated jpg images of a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path).select("path")
    files = files.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), F.element_at(F.split("path", "/"), -2).alias("folder"))
    return files.withColumn("chart_date", F.regexp_extract("file_name", IMAGE, 1)).filter("chart_date <> ''")


def merged_name(folder: Column) -> Column:
    """Name of a folder's merged table."""
    return F.concat(F.regexp_replace(folder, " ", "_"), F.lit("_merged.csv"))


def flatten_document(docs: DataFrame, pages: str = "pages") -> DataFrame:
    """Words of nested documents (pages > blocks > lines > words with value and geometry) with ord, their order of emission."""
    keep = [c for c in docs.columns if c != pages]
    at = docs
    for level, inner in (("p", pages), ("b", "p.blocks"), ("l", "b.lines"), ("w", "l.words")):
        at = at.select("*", F.posexplode(inner).alias(f"{level}_at", level))
    order = F.struct("p_at", "b_at", "l_at", "w_at")
    word = F.struct(order.alias("at"), F.col("w.value").alias("text"), F.col("w.geometry").alias("g"))
    rows = at.groupBy(*keep).agg(F.array_sort(F.collect_list(word)).alias("ws")).select(*keep, F.posexplode("ws").alias("ord", "x"))
    corner = lambda i, j: F.col("x.g")[i][j]
    return rows.select(*keep, "ord", "x.text", corner(0, 0).alias("x0"), corner(0, 1).alias("y0"), corner(1, 0).alias("x1"), corner(1, 1).alias("y1"))


def recognize(images: DataFrame, load: Callable[[], Callable[[bytes], list[dict]]]) -> DataFrame:
    """Word boxes of images (path, content) by a model that `load` returns, loaded once a task; images it fails on give none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for b in batches:
            out = []
            for path, content in zip(b["path"], b["content"]):
                try:
                    out += [{"file_name": path.rsplit("/", 1)[-1], "ord": i} | w for i, w in enumerate(model(content))]
                except Exception:  # noqa: BLE001 - a broken image mustn't end the job
                    continue
            yield pd.DataFrame(out, columns=WORDS.names)

    return images.select("path", "content").mapInPandas(run, WORDS)


def write_ordered_csv(df: DataFrame, path: str, *order: Column, without: tuple[str, ...] = ()) -> None:
    """One csv file with header, rows in the order given; `without`: columns that only serve the order."""
    df.repartition(1).sortWithinPartitions(*order).drop(*without).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_xlsx(df: DataFrame, path: str, most: int = 1_048_575) -> bool:
    """An Excel sheet, which is bounded by its format; False where openpyxl isn't installed."""
    try:
        import openpyxl  # noqa: F401
    except ImportError:
        return False
    n = df.limit(most + 1).count()
    if n > most:
        raise ValueError(f"a sheet holds at most {most} rows")
    df.toPandas().to_excel(path, index=False)
    return True


def write_report(report: DataFrame, path: str) -> None:
    """A one-row table as one JSON document."""
    row = report.first()
    with open(path, "w") as f:
        json.dump(row.asDict() if row else {}, f, default=str)


def file_targets(files: DataFrame, name: str = "file_name") -> DataFrame:
    """files with date and month, the folder a dated image belongs to; others and impossible dates have null."""
    y, m, d = (F.regexp_extract(name, DATED_IMAGE, i) for i in (1, 2, 3))
    date = F.when(y != "", F.concat_ws("-", y, m, d)).try_cast("date")
    return files.withColumn("date", date).withColumn("month", month_folder(F.col("date")))
