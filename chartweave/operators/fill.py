"""Filling missing chart cells from records of the same song, week or market."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartweave.functions.cells import day_first_date, whole_number
from chartweave.operators.entities import anagram_parts, with_song

#: Field -> highest usable value.
FIELDS = {"rank": 100, "peak": 100, "weeks_on_chart": 500}


def fill_chart_gaps(df: DataFrame, max_gap_days: int = 84) -> DataFrame:
    """Every row of a chart table with rank, peak and weeks_on_chart filled and marked.

    Time-ordered filling per entity (market + song + artist, apart from case, blanks, marks,
    the order of credited names and exchanged places; anagrams are other entities). Adds for each field F
      F_filled    int, the usable or the filled value (null only if nothing in its market's chart of that week helps),
      F_method    'observed'; 'same_week' (a copy of the record), 'interpolated' (between observed
                  neighbours), 'carried' (from one neighbour; weeks_on_chart moves with the weeks),
                  'chart_median' (of the songs of the same market and week); 'none',
      F_distance  days to the farther record used, null for observed, chart_median and none.
    peak is a category: it is carried, never interpolated, and never worse than the rank observed
    in that week. A neighbour farther than max_gap_days isn't used.

    Cases: null or unreadable cells and dates count as missing; a row without date,
    or with blank song and artist, has no entity and takes only the chart median, or 'none'.
    Ties: where copies of a week disagree, the smallest observed value counts.
    Repeated rows stay. An empty table gives an empty table. Extra columns stay; columns
    of the input that have a name added here are replaced.

    Plan: rows are first aggregated (map side) to one record per entity and week, so the
    windows see the weeks of a song, never its copies; a hot song is small there. Rows
    without a gap go out as they are read; only rows with one are shuffled, once, and joined with
    the weeks that have one, where AQE splits a skewed side.
    """
    names = [f"{f}_{x}" for f in FIELDS for x in ("filled", "method", "distance")]
    kept = [c for c in df.columns if c not in names]
    own = {f: whole_number(F.col(f), 1, hi).alias(f"__{f}") for f, hi in FIELDS.items()}
    read = df.select(*[F.col(f"`{c}`") for c in kept], *own.values())
    whole = " and ".join(f"__{f} is not null" for f in FIELDS)
    fine = read.filter(whole).select(
        *[F.col(f"`{c}`") for c in kept],
        *[x for f in FIELDS for x in (F.col(f"__{f}").alias(f"{f}_filled"), F.lit("observed").alias(f"{f}_method"), F.lit(None).cast("int").alias(f"{f}_distance"))],
    )
    parts = anagram_parts(df)
    day = F.datediff(day_first_date(F.col("chart_date")), F.lit("1970-01-01").cast("date")).alias("__day")

    weeks = with_song(df.select("market", "song", "artist", day, *own.values()), parts).filter("__day is not null")
    # rows without an entity only say that their chart has a gap
    values = [F.min(F.when(F.col("__song").isNotNull(), F.col(f"__{f}"))).alias(f"__w_{f}") for f in FIELDS]
    gap = F.max(F.expr(f"not ({whole})")).alias("__gap")
    weeks = weeks.groupBy(F.col("market").alias("__m"), F.col("__song").alias("__s"), F.col("__part").alias("__p"), F.col("__day").alias("__d")).agg(*values, gap)
    # one row per chart with a gap, over its songs; from the same exchange as the windows
    medians = [F.percentile_approx(f"__w_{f}", 0.5).alias(f"__c_{f}") for f in FIELDS]
    charts = weeks.groupBy(F.col("__m").alias("__cm"), F.col("__d").alias("__cd")).agg(*medians, F.max("__gap").alias("__cg")).filter("__cg").drop("__cg")
    by = ["__m", "__s", "__p"]
    back = Window.partitionBy(*by).orderBy("__d").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*by).orderBy(F.col("__d").desc()).rowsBetween(Window.unboundedPreceding, -1)
    seen = {f: F.when(F.col(f"__w_{f}").isNotNull(), F.struct(F.col("__d").alias("d"), F.col(f"__w_{f}").alias("v"))) for f in FIELDS}
    weeks = weeks.select("*", *[F.last(x, True).over(back).alias(f"__b_{f}") for f, x in seen.items()])
    weeks = weeks.select("*", *[F.last(x, True).over(ahead).alias(f"__a_{f}") for f, x in seen.items()])
    weeks = weeks.filter("__gap").select(*by, "__d", "__w_rank", *[_guess(f, max_gap_days).alias(f"__g_{f}") for f in FIELDS])

    rows = with_song(read.filter(f"not ({whole})").withColumn("__day", day), parts)
    # null-safe equality: rows without an entity or a date keep their place, and a null market is one market
    rows = rows.join(weeks, F.col("market").eqNullSafe(F.col("__m")) & F.col("__song").eqNullSafe(F.col("__s")) & (F.col("__part") == F.col("__p")) & F.col("__day").eqNullSafe(F.col("__d")), "left")
    rows = rows.join(charts, F.col("market").eqNullSafe(F.col("__cm")) & F.col("__day").eqNullSafe(F.col("__cd")), "left")
    new = []
    for f in FIELDS:
        cell, guess, median = F.col(f"__{f}"), F.col(f"__g_{f}"), F.col(f"__c_{f}")
        method = F.when(cell.isNotNull(), "observed").when(guess.isNotNull(), guess["method"]).when(median.isNotNull(), "chart_median").otherwise("none")
        filled = F.coalesce(guess["value"], median)
        if f == "peak":
            filled = F.when(filled.isNotNull(), F.least(filled, F.col("__rank"), F.col("__w_rank")))
        new += [F.coalesce(cell, filled).alias(f"{f}_filled"), method.alias(f"{f}_method"), F.when(cell.isNull(), guess["distance"]).alias(f"{f}_distance")]
    return fine.unionByName(rows.select(*[F.col(f"`{c}`") for c in kept], *new))


def _guess(field: str, max_gap_days: int) -> Column:
    """struct<value, method, distance> for a week of a song, null if its neighbours don't help."""
    own, b, a, day = F.col(f"__w_{field}"), F.col(f"__b_{field}"), F.col(f"__a_{field}"), F.col("__d")
    to_b, to_a = day - b["d"], a["d"] - day
    near_b, near_a = b.isNotNull() & (to_b <= max_gap_days), a.isNotNull() & (to_a <= max_gap_days)

    def made(value: Column, method: str, distance: Column) -> Column:
        return F.struct(value.cast("int").alias("value"), F.lit(method).alias("method"), distance.cast("int").alias("distance"))

    out = F.when(own.isNotNull(), made(own, "same_week", F.lit(0)))
    if field == "peak":
        return out.when(near_b & (~near_a | (to_b <= to_a)), made(b["v"], "carried", to_b)).when(near_a, made(a["v"], "carried", to_a))
    step = (F.round(to_b / 7), F.round(to_a / 7)) if field == "weeks_on_chart" else (F.lit(0), F.lit(0))
    hi = FIELDS[field]
    line = F.round(b["v"] + (a["v"] - b["v"]) * to_b / (to_b + to_a))
    out = out.when(near_b & near_a, made(line, "interpolated", F.greatest(to_b, to_a)))
    out = out.when(near_b, made(F.least(b["v"] + step[0], F.lit(hi)), "carried", to_b))
    return out.when(near_a, made(F.greatest(a["v"] - step[1], F.lit(1)), "carried", to_a))


def missing_cells(filled: DataFrame) -> DataFrame:
    """(row_id, field) of each cell that fill_chart_gaps had to fill or could not."""
    marks = F.array_compact(F.array(*[F.when(F.col(f"{f}_method") != "observed", F.lit(f)) for f in FIELDS]))
    return filled.select("row_id", F.explode(marks).alias("field"))
