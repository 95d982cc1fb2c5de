"""Explicit schemas: every raw cell is a string, missing cells are nulls or blanks."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_COLUMNS = (
    "chart_date", "rank", "change", "song", "artist", "points", "percent", "peak", "woc",
    "sales", "sales_percent", "streams", "streams_percent", "airplay", "airplay_percent", "units",
)
#: Names in exported templates -> names used here.
TEMPLATE_NAMES = {"percent_change": "percent", "weeks_on_chart": "woc"}


def raw_schema(mbid: bool = False) -> T.StructType:
    """The 16 raw columns as strings, with mbid as 17th if asked."""
    names = (*RAW_COLUMNS, "mbid") if mbid else RAW_COLUMNS
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


WORDS = T.StructType(
    [T.StructField("file_name", T.StringType()), T.StructField("image_height", T.IntegerType()), T.StructField("ord", T.IntegerType()), T.StructField("text", T.StringType())]
    + [T.StructField(n, T.DoubleType()) for n in ("x0", "y0", "x1", "y1")]
)
_CREDIT = T.StructType([T.StructField("artist", T.StructType([T.StructField("name", T.StringType())])), T.StructField("literal", T.StringType())])
RECORDINGS = T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("title", T.StringType()), T.StructField("artist-credit", T.ArrayType(_CREDIT))]))
POSTS = T.StructType(
    [
        T.StructField("id", T.StringType()), T.StructField("created_at", T.StringType()), T.StructField("full_text", T.StringType()),
        T.StructField("media", T.ArrayType(T.StructType([T.StructField("type", T.StringType()), T.StructField("url", T.StringType())]))),
    ]
)
