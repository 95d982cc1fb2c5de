"""Tables from positioned words: rows by vertical gaps, columns by horizontal edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartweave.functions.dates import file_date
from chartweave.schema import RAW_COLUMNS

# fixed values: left edges of the 14 columns and the right edge of the last, as shares of the width
COLUMN_EDGES = (0.021, 0.067, 0.110, 0.434, 0.491, 0.536, 0.572, 0.613, 0.667, 0.706, 0.767, 0.806, 0.869, 0.908, 0.974)
# fixed values: edges of 26 rows, as shares of the height, where gaps show none
ROW_EDGES = (
    0.025, 0.046, 0.083, 0.121, 0.160, 0.195, 0.235, 0.271, 0.306, 0.342, 0.384, 0.419, 0.454, 0.489,
    0.531, 0.565, 0.605, 0.639, 0.677, 0.716, 0.752, 0.789, 0.827, 0.862, 0.900, 0.937, 0.972,
)
# fixed values: row gap in pixels, as a share where the height is unknown, and the song's part of its cell
GAP_PIXELS, GAP_SHARE, SONG_PART = 15.0, 0.02, 0.6


def bucket(x: Column, edges: tuple[float, ...]) -> Column:
    """Number of the half-open interval between edges in which x lies, null outside."""
    out = F.when(x < edges[0], F.lit(None).cast("int"))
    for i, edge in enumerate(edges[1:]):
        out = out.when(x < edge, F.lit(i))
    return out


def even_edges(words: DataFrame, by: str = "file_name", n: int = 14) -> DataFrame:
    """(by, edges): n evenly spaced columns between the least and greatest centre of each file's words."""
    x = (F.col("x0") + F.col("x1")) / 2
    span = words.groupBy(by).agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    return span.select(by, F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: F.col("lo") + (F.col("hi") - F.col("lo")) * i / n).alias("edges"))


def tolerance(image_height: Column) -> Column:
    """Largest gap within a row, as a share of the height."""
    return F.coalesce(F.lit(GAP_PIXELS) / image_height, F.lit(GAP_SHARE))


def detect_rows(words: DataFrame, by: str, y: Column, order: Column, gap: Column, name: str = "row_id") -> DataFrame:
    """words with the number of its row (from 0): a new row begins where the gap to the word before is larger than `gap`.

    Words of a group are taken by y, then order. Rows chain: only neighbouring words are compared.
    """
    along = Window.partitionBy(by).orderBy(y, order)
    step = words.withColumn("__new", F.coalesce((y - F.lag(y).over(along) > gap).cast("int"), F.lit(0)))
    return step.withColumn(name, F.sum("__new").over(along.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def fixed_rows(words: DataFrame, y: Column, edges: tuple[float, ...] = ROW_EDGES, name: str = "row_id") -> DataFrame:
    """words within the rows between fixed edges, numbered; words outside are left out."""
    return words.withColumn(name, bucket(y, edges)).filter(F.col(name).isNotNull())


def reconstruct_table(words: DataFrame, edges: tuple[float, ...] = COLUMN_EDGES) -> DataFrame:
    """The chart tables in positioned words (file_name, image_height, ord, text, x0, y0, x1, y1).

    One row per detected row but the first of each file (the header): src_file, pos, and the 16
    raw columns, '' where nothing stands. In the third column words in the upper part of the
    row are the song, the others the artist, joined in order of height; in other columns the
    last word counts. Words outside the edges are left out. An empty table gives an empty table.

    Plan: one shuffle by file for the windows; cells are one aggregate by (file, row) on top of
    that partitioning.
    """
    yc, xc = (F.col("y0") + F.col("y1")) / 2, (F.col("x0") + F.col("x1")) / 2
    w = detect_rows(words, "file_name", yc, F.col("ord"), tolerance(F.col("image_height")))
    row = Window.partitionBy("file_name", "row_id")
    low, high = F.min("y0").over(row), F.max("y1").over(row)
    w = w.withColumn("__rel", F.when(high > low, (yc - low) / (high - low)).otherwise(F.lit(0.0)))
    w = w.withColumn("__col", bucket(xc, edges)).withColumn("__at", F.struct(yc.alias("y"), F.col("ord")))

    def last(i: int) -> Column:
        return F.coalesce(F.max_by(F.when(F.col("__col") == i, F.col("text")), F.when(F.col("__col") == i, F.col("__at"))), F.lit(""))

    def joined(part: Column) -> Column:
        words_ = F.collect_list(F.when((F.col("__col") == 2) & part, F.struct(F.col("__at"), F.col("text"))))
        return F.array_join(F.transform(F.array_sort(words_), lambda x: x["text"]), " ")

    upper = F.col("__rel") <= SONG_PART
    cells = [last(0), last(1), joined(upper), joined(~upper), *[last(i) for i in range(3, 14)]]
    named = [c.alias(n) for c, n in zip(cells, RAW_COLUMNS[1:])]
    t = w.groupBy("file_name", "row_id").agg(*named).filter("row_id > 0")
    date = file_date(F.col("file_name")).alias(RAW_COLUMNS[0])
    return t.select(F.col("file_name").alias("src_file"), (F.col("row_id") - 1).cast("bigint").alias("pos"), date, *RAW_COLUMNS[1:])
