"""The chart pipeline from a folder of tables to one clean table and its report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartweave.functions.dates import FORMATS
from chartweave.operators.cluster import standardize
from chartweave.operators.counts import match_report, standardization_summary
from chartweave.operators.merge import merge_charts, normalize_cells, repair_cells
from chartweave.operators.ordering import number_rows
from chartweave.operators.resolve import Similarity, apply_names, quick_similarity, resolve_answers
from chartweave.schema import RAW_COLUMNS
from chartweave.session import cut
from chartweave.sources.files import read_charts, write_ordered_csv


def clean_charts(charts: DataFrame) -> DataFrame:
    """charts (16 raw columns, src_file, pos) with repaired and normalized cells, in standard spellings, and raw_id."""
    return standardize(number_rows(normalize_cells(repair_cells(charts))), order="raw_id")


def run_pipeline(
    spark: SparkSession, source: str, target: str, answers: DataFrame | None = None, forms: tuple[str, ...] = FORMATS, mbid: bool = False, similarity: Similarity = quick_similarity
) -> DataFrame:
    """Reads the csv files of `source`, writes the merged chart as one csv file to `target` and returns a one-row report.

    Cells are repaired and normalized, spellings standardized, and names replaced by accepted ones of
    `answers` (combo_hash, song, artist, recordings), if there are any. Newest dates come first, ranks in order within
    a date, unranked rows keep their place. The default similarity of answers is the built-in quick one;
    similarity.blended_similarity gives the blend of five ratios. The report holds the standardization's
    summary and, with answers, the counts of matches. A folder without rows gives a table of only a header and zeros.

    Plan: the table is cut to the shared folder after reading and after cleaning, since both are used more than once.
    """
    raw = cut(read_charts(spark, source))
    clean = cut(clean_charts(raw))
    report = standardization_summary(raw, clean)
    if answers is not None:
        resolved = cut(resolve_answers(answers, similarity=similarity))
        clean = apply_names(clean, resolved, mbid)
        report = report.join(F.broadcast(match_report(resolved).withColumnRenamed("pairs", "looked_up")), F.lit(True))
    named = [*RAW_COLUMNS, *(["mbid"] if mbid and answers is not None else [])]
    merged = merge_charts(clean, forms=forms).select(*named, "date", "out_pos")
    write_ordered_csv(merged, target, F.col("date").desc_nulls_last(), F.col("out_pos"), without=("date", "out_pos"))
    return report
