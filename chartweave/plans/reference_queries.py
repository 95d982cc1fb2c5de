"""Queries of the chart pipeline's operators and the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartweave.functions import similarity as sim
from chartweave.functions.dates import SEQUENTIAL_FORMATS, announced_date, file_date, month_folder, parse_date, posted_at
from chartweave.functions.keys import combo_hash as hash_of
from chartweave.functions.numeric import rank_number, repair_change, repair_number
from chartweave.functions.text import ACCENTED, FURNITURE, PLAIN, comparison_text, likely_song, normalize_credit, normalize_text, search_text, split_change, valid_pair
from chartweave.operators import cluster, counts, merge, ordering, resolve, rows
from chartweave.schema import RAW_COLUMNS
from chartweave.session import table
from chartweave.sources import files, posts
from chartweave.streaming.resume import windowed_counts

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# SQL fragments of the text rules; RE2 knows classes by script, not (?U)
WS = r"[\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def sub(x: str, pattern: str, to: str = "", flags: str = "g") -> str:
    return f"regexp_replace({x}, '{pattern.replace(chr(39), chr(39) * 2)}', '{to.replace(chr(39), chr(39) * 2)}', '{flags}')"


def strip_sql(x: str) -> str:
    return sub(x, f"^{WS}+|{WS}+$")


def blank_sql(x: str) -> str:
    return f"({x} IS NULL OR length({strip_sql(x)}) = 0)"


def normal_sql(x: str) -> str:
    t = sub(strip_sql(f"coalesce({x}, '')"), "^=+")
    t = sub(f"lower(translate({t}, '{ACCENTED}', '{PLAIN}'))", r'[\[\]{}()"«»‚„]+')
    return strip_sql(sub(t, f"{WS}+", " "))


def credit_sql(x: str) -> str:
    t = sub(x, r"\b(feat\.?|featuring|ft\.?)\b", "feat.", "gi")
    t = sub(t, f"{WS}+&{WS}+", " and ")
    for kind in ("remix", f"radio{WS}+edit", "live", "acoustic", "instrumental"):
        t = sub(t, rf"{WS}*\([^)]*{kind}[^)]*\)", "", "gi")
    return strip_sql(sub(t, f"{WS}+", " "))


def compare_sql(x: str) -> str:
    t = sub(x, rf"\b(feat\.?|featuring|ft\.?){WS}+.*$", "", "gi")
    t = sub(sub(t, rf"{WS}*\([^)]*\)"), rf"{WS}*\[[^\]]*\]")
    t = sub(t, r"[^\p{L}\p{M}\p{N}_\s\x{A0}]")
    return strip_sql(sub(t, f"{WS}+", " "))


def search_sql(x: str) -> str:
    t = sub(strip_sql(f"coalesce({x}, '')"), rf"\b(feat\.?|featuring|ft\.?){WS}+.*$", "", "gi")
    t = sub(sub(t, rf"{WS}*\([^)]*\){WS}*", " "), rf"{WS}*\[[^\]]*\]{WS}*", " ")
    return sub(strip_sql(sub(t, f"{WS}+", " ")), r'([+\-&|!(){}\[\]^"~*?:\\])', r"\\\1")


def hash_sql(song: str, artist: str) -> str:
    return f"md5(lower(trim(coalesce({song}, ''))) || '|' || lower(trim(coalesce({artist}, ''))))"


def rank_sql(x: str) -> str:
    t = strip_sql(x)
    return f"CASE WHEN regexp_full_match({t}, '[+-]?[0-9]+') THEN try_cast({t} AS INTEGER) END"


def quick_sql(a: str, b: str) -> str:
    """quick_similarity of two columns, over ASCII and other letters alike (edit distance by characters)."""
    x, y = strip_sql(f"lower({a})"), strip_sql(f"lower({b})")
    p, q = compare_sql(x), compare_sql(y)
    # DuckDB's edit distance counts bytes, so accented letters stand as marks that these texts don't hold
    one = lambda t: f"translate({t}, 'áàâäãåéèêëíìîïóòôöõúùûüýÿñç', '!#$%&()*+,-./:;<=>?@[]^{{|}}~')"
    edit = f"CASE WHEN length({p}) = 0 OR length({q}) = 0 THEN 0.0 ELSE (greatest(length({p}), length({q})) - levenshtein({one(p)}, {one(q)})) / greatest(length({p}), length({q})) * 100.0 END"
    inside = f"CASE WHEN length({p}) > 0 AND length({q}) > 0 AND (contains({p}, {q}) OR contains({q}, {p})) THEN 10.0 ELSE 0.0 END"
    return f"CASE WHEN {x} = {y} THEN 100.0 WHEN {p} = {q} THEN 95.0 ELSE 0.8 * ({edit}) + {inside} END"


def ratio_sql(a: str, b: str) -> str:
    """indel_ratio: the longest common subsequence with bits in parallel, texts of up to 120 characters."""
    places = f"list_transform(string_split({b}, ''), lambda ch: coalesce(list_sum(list_transform(range(length({a})), lambda i: CASE WHEN {a}[i + 1] = ch THEN 1::HUGEINT << i ELSE 0::HUGEINT END)), 0)::HUGEINT)"
    full = f"((1::HUGEINT << length({a})) - 1)"
    row = f"list_reduce(list_prepend({full}, {places}), lambda v, m: ((v + (v & m)) | (v & xor(m, {full}))) & {full})"
    lcs = f"(length({a}) - bit_count({row}))"
    return f"CASE WHEN length({a}) = 0 AND length({b}) = 0 THEN 100.0 WHEN length({a}) = 0 OR length({b}) = 0 THEN 0.0 ELSE 200.0 * {lcs} / (length({a}) + length({b})) END"


def standard_sql(name: str, src: str, value: str, threshold: float, by: str = "''") -> str:
    """CTEs `name` (by, variant, standard) of greedy leader clustering of `value` in rows src (raw_id, song, artist): one step per value, in order."""
    return f"""{name}_v AS (SELECT *, row_number() OVER (ORDER BY first) k FROM (SELECT {by} g, {value} v, min(raw_id) first, count(*) n FROM {src} GROUP BY 1, 2)),
    {name}_p AS (SELECT a.k i, b.k j FROM {name}_v a JOIN {name}_v b ON a.g = b.g AND a.k < b.k AND 2 * least(length(a.v), length(b.v)) >= {threshold} / 100.0 * (length(a.v) + length(b.v)) - 1e-9 WHERE {ratio_sql('a.v', 'b.v')} >= {threshold}),
    {name}_n AS (SELECT k, coalesce(list(i) FILTER (i IS NOT NULL), []) near FROM {name}_v LEFT JOIN {name}_p ON k = j GROUP BY k),
    {name}_s AS (SELECT 0::BIGINT k, []::BIGINT[] leads UNION ALL SELECT n.k, CASE WHEN list_has_any(s.leads, n.near) THEN s.leads ELSE list_append(s.leads, n.k) END FROM {name}_s s JOIN {name}_n n ON n.k = s.k + 1),
    {name}_l AS (SELECT leads FROM {name}_s ORDER BY k DESC LIMIT 1),
    {name}_c AS (SELECT v.*, CASE WHEN list_contains(leads, v.k) THEN v.k ELSE list_min(list_intersect(leads, n.near)) END lead FROM {name}_v v JOIN {name}_n n USING (k), {name}_l),
    {name} AS (SELECT g, v AS variant, first_value(v) OVER (PARTITION BY g, lead ORDER BY n DESC, first) AS standard FROM {name}_c)"""


COMBINED_SQL = "CASE WHEN ss = 100 AND sa >= 85 THEN 98.0 WHEN sa = 100 AND ss >= 85 THEN 95.0 WHEN ss >= 95 AND sa >= 95 THEN 96.0 ELSE ss * 0.65 + sa * 0.35 END"


# --- order and merging


@query(
    f"""WITH r AS (SELECT raw_id, src_file, pos, {rank_sql('"rank"')} rk FROM chart_raw),
    n AS (SELECT *, row_number() OVER (PARTITION BY src_file, rk IS NULL ORDER BY rk, pos) k FROM r),
    s AS (SELECT src_file, pos place, row_number() OVER (PARTITION BY src_file ORDER BY pos) k FROM r WHERE rk IS NOT NULL)
    SELECT raw_id, n.src_file, rk rank_number, CASE WHEN rk IS NULL THEN pos ELSE place END out_pos
    FROM n LEFT JOIN s ON n.src_file = s.src_file AND n.k = s.k AND n.rk IS NOT NULL"""
)
def position_preserving_sort(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "chart_raw").select("raw_id", "src_file", "pos", rank_number(F.col("rank")).alias("rank_number"))
    return ordering.sort_keeping_places(t, ["src_file"], "rank_number", "pos").select("raw_id", "src_file", "rank_number", "out_pos")


@query(
    f"""WITH r AS (SELECT raw_id, try_strptime(trim(chart_date), '%m/%d/%y')::DATE "date", {rank_sql('"rank"')} rk, src_file, pos FROM chart_raw),
    p AS (SELECT *, row_number() OVER (PARTITION BY "date" ORDER BY src_file, pos, raw_id) - 1 nr FROM r WHERE "date" IS NOT NULL),
    n AS (SELECT *, row_number() OVER (PARTITION BY "date", rk IS NULL ORDER BY rk, nr) k FROM p),
    s AS (SELECT "date", nr place, row_number() OVER (PARTITION BY "date" ORDER BY nr) k FROM p WHERE rk IS NOT NULL)
    SELECT raw_id, n."date", CASE WHEN rk IS NULL THEN nr ELSE place END out_pos FROM n LEFT JOIN s ON n."date" = s."date" AND n.k = s.k AND n.rk IS NOT NULL"""
)
def merge_order(spark: SparkSession, d: str) -> DataFrame:
    return merge.merge_charts(table(spark, d, "chart_raw")).select("raw_id", "date", "out_pos")


@query(
    f"""SELECT raw_id, row_number() OVER (ORDER BY try_strptime(trim(chart_date), '%m/%d/%y') DESC NULLS LAST, {rank_sql('"rank"')} ASC NULLS LAST, raw_id) AS place FROM chart_raw"""
)
def global_chart_order(spark: SparkSession, d: str) -> DataFrame:
    # the place of each row in the whole table: counted per date first, so that no task sorts everything
    t = table(spark, d, "chart_raw").select("raw_id", parse_date(F.col("chart_date"), "m/d/y").alias("date"), rank_number(F.col("rank")).alias("rk"))
    sizes = t.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select(F.col("date").alias("d2"), F.coalesce(F.sum("n").over(Window.orderBy(F.col("date").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = t.withColumn("k", F.row_number().over(Window.partitionBy("date").orderBy(*ordering.chart_order("date", "rk", "raw_id"))))
    return within.join(before, F.col("date").eqNullSafe(F.col("d2"))).select("raw_id", (F.col("before") + F.col("k")).alias("place"))


@query(
    """SELECT market, src_file, pos, song, artist, percent_change AS percent, woc, raw_id, NULL::BIGINT AS row_id FROM chart_raw
    UNION ALL SELECT market, src_file, pos, song, artist, percent_change, weeks_on_chart, NULL, row_id FROM chart_template"""
)
def union_by_name(spark: SparkSession, d: str) -> DataFrame:
    raw, template = (merge.rename_template(table(spark, d, t)) for t in ("chart_raw", "chart_template"))
    return merge.union_all(raw.drop("chart_date"), template.drop("chart_date", "loaded_at")).select("market", "src_file", "pos", "song", "artist", "percent", "woc", "raw_id", "row_id")


@query(
    """WITH f AS (SELECT regexp_full_match(arg_min(chart_date, row_id), '[0-9]{1,2}-[0-9]{1,2}-[0-9]{2}') turn FROM chart_template WHERE chart_date IS NOT NULL)
    SELECT row_id, CASE WHEN turn THEN regexp_replace(chart_date, '^(\\d{1,2})-(\\d{1,2})-(\\d{2})$', '\\2/\\1/\\3') ELSE chart_date END chart_date FROM chart_template, f"""
)
def unified_dates(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "chart_template").select("row_id", "chart_date")
    return merge.unify_date_text(t, order="row_id").select("row_id", "chart_date")


# --- scalar rules


@query(f"SELECT entry_id, {credit_sql(normal_sql('song'))} song, {credit_sql(normal_sql('artist'))} artist, {normal_sql('song')} plain FROM song_entries")
def normalized_text(spark: SparkSession, d: str) -> DataFrame:
    s, a = normalize_text(F.col("song")), normalize_text(F.col("artist"))
    return table(spark, d, "song_entries").select("entry_id", normalize_credit(s).alias("song"), normalize_credit(a).alias("artist"), s.alias("plain"))


_T = strip_sql("song")
_MOVES = f"({blank_sql('change')} AND regexp_full_match({_T}, '(?s)[+-]?[0-9]+{WS}+.+'))"


@query(
    f"""SELECT row_id, CASE WHEN {_MOVES} THEN {strip_sql(f"regexp_extract({_T}, '(?s)^([+-]?[0-9]+){WS}+(.+)$', 2)")} WHEN {blank_sql('change')} AND length(song) > 0 THEN {_T} ELSE song END song,
    CASE WHEN {_MOVES} THEN CASE WHEN regexp_extract({_T}, '^([+-]?[0-9]+)', 1)::BIGINT > 0 THEN '+' ELSE '' END || regexp_extract({_T}, '^([+-]?[0-9]+)', 1)::BIGINT::VARCHAR ELSE change END change FROM chart_template"""
)
def moved_changes(spark: SparkSession, d: str) -> DataFrame:
    song, change = split_change(F.col("song"), F.col("change"))
    return table(spark, d, "chart_template").select("row_id", song.alias("song"), change.alias("change"))


def repair_sql(x: str) -> str:
    t = f"translate({sub(strip_sql(x), '[, ]')}, 'OIlSB', '01158')"
    head = f"left({t}, length({t}) - 1)"
    value = f"CASE WHEN regexp_full_match({head}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN try_cast({head} AS DOUBLE) ELSE try_cast(nullif(regexp_extract({head}, '([0-9]+\\.?[0-9]*)', 1), '') AS DOUBLE) END"

    def times(n: int) -> str:
        return f"coalesce(trunc({value} * {n})::BIGINT::VARCHAR, {t})"

    bare = sub(t, r"[^0-9.]")
    return f"CASE WHEN {blank_sql(x)} THEN '' WHEN regexp_matches({t}, '[kK]$') THEN {times(1000)} WHEN regexp_matches({t}, '[mM]$') THEN {times(1000000)} WHEN regexp_matches({t}, '[0-9][a-zA-Z]$') THEN regexp_extract({t}, '([0-9]+\\.?[0-9]*)', 1) WHEN {bare} <> '' THEN {bare} ELSE {t} END"


@query(f"SELECT raw_id, {', '.join(f'{repair_sql(c)} {c}' for c in ('sales', 'streams', 'airplay', 'units'))} FROM chart_raw")
def repaired_numbers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chart_raw").select("raw_id", *[repair_number(F.col(c)).alias(c) for c in ("sales", "streams", "airplay", "units")])


_C = f"translate({strip_sql('change')}, 'I', '1')"


@query(
    f"""SELECT row_id, CASE WHEN {blank_sql('change')} THEN '' WHEN upper({_C}) = 'NEW' THEN 'NEW' WHEN regexp_full_match({_C}, '[+-][0-9]+') THEN {_C}
    WHEN regexp_matches({_C}, '[0-9]') THEN CASE WHEN starts_with({_C}, '-') OR contains(lower({_C}), 'down') THEN '-' ELSE '+' END || regexp_extract({_C}, '([0-9]+)', 1) ELSE '' END change FROM chart_template"""
)
def repaired_changes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chart_template").select("row_id", repair_change(F.col("change")).alias("change"))


@query(
    r"""SELECT raw_id, try_strptime(trim(chart_date), '%m/%d/%y')::DATE "date", strftime(try_strptime(trim(chart_date), '%m/%d/%y'), '%b %y') "month",
    regexp_replace(regexp_extract(src_file, '\d{4}-\d{2}-\d{2}_\d+'), '^\d\d(\d\d)-(\d\d)-(\d\d)_\d+$', '\2/\3/\1') file_date FROM chart_raw"""
)
def dates(spark: SparkSession, d: str) -> DataFrame:
    day = parse_date(F.col("chart_date"), "m/d/y")
    return table(spark, d, "chart_raw").select("raw_id", day.alias("date"), month_folder(day).alias("month"), file_date(F.col("src_file")).alias("file_date"))


@query("""SELECT row_id, CASE WHEN regexp_full_match(trim(chart_date), '[0-9]{1,2}-[0-9]{1,2}-[0-9]{2}') THEN try_strptime(trim(chart_date), '%d-%m-%y')::DATE END "date" FROM chart_template""")
def sequential_dates(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "chart_template").select("row_id", "chart_date")
    return merge.with_dates(t, forms=SEQUENTIAL_FORMATS).select("row_id", "date")


@query("""SELECT raw_id, try_strptime(trim(chart_date), '%m/%d/%y')::DATE "date" FROM chart_raw""")
def free_dates(spark: SparkSession, d: str) -> DataFrame:
    # dates written out, which none of the fixed formats reads
    t = table(spark, d, "chart_raw").select("raw_id", F.date_format(parse_date(F.col("chart_date"), "m/d/y"), "MMMM d, yyyy").alias("chart_date"))
    return merge.with_dates(t).select("raw_id", "date")


@query(f"SELECT raw_id, {hash_sql('song', 'artist')} combo_hash FROM chart_raw")
def combo_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chart_raw").select("raw_id", hash_of(F.col("song"), F.col("artist")).alias("combo_hash"))


@query(f"SELECT raw_id, {search_sql('song')} search_song, {search_sql('artist')} search_artist, {compare_sql('song')} compare_song, {compare_sql('artist')} compare_artist FROM chart_raw")
def comparison_forms(spark: SparkSession, d: str) -> DataFrame:
    s, a = F.col("song"), F.col("artist")
    return table(spark, d, "chart_raw").select("raw_id", search_text(s).alias("search_song"), search_text(a).alias("search_artist"), comparison_text(s).alias("compare_song"), comparison_text(a).alias("compare_artist"))


_QS, _QA = search_sql("title"), search_sql("artist_credit")


@query(
    f"""WITH s AS (SELECT recording_id, {_QS} s, {_QA} a FROM catalogue), q AS (SELECT recording_id, ['recording:' || s || ' AND artist:' || a, 'recording:"' || s || '" AND artist:"' || a || '"',
    'recording:"' || s || '" OR artist:"' || a || '"', 'recording:' || s || ' OR artist:' || a, 'recording:"' || s || '"', 'artist:"' || a || '"', 'recording:' || s, 'artist:' || a] qs FROM s)
    SELECT recording_id, unnest(range(1, 9))::INTEGER strategy, unnest(qs) query FROM q"""
)
def search_queries(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "catalogue").select("recording_id", F.posexplode(resolve.search_ladder(F.col("title"), F.col("artist_credit"))).alias("at", "query"))
    return q.select("recording_id", (F.col("at") + 1).alias("strategy"), "query")


# --- rows and columns


@query(
    """WITH e AS (SELECT user_id, event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY value, event_id) v FROM events)
    SELECT user_id, event_id, (sum(CASE WHEN value - v > 0.5 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY value, event_id ROWS UNBOUNDED PRECEDING))::BIGINT row_id FROM e"""
)
def row_detection(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_id", "value")
    return rows.detect_rows(e, "user_id", F.col("value"), F.col("event_id"), F.lit(0.5)).select("user_id", "event_id", "row_id")


@query(f"SELECT event_id, CASE {' '.join(f'WHEN x < {e} THEN {i - 1}' if i else f'WHEN x < {e} THEN NULL' for i, e in enumerate(rows.COLUMN_EDGES))} END::INTEGER AS bucket FROM (SELECT event_id, value / 100.0 x FROM events)")
def column_buckets(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", rows.bucket(F.col("value") / 100.0, rows.COLUMN_EDGES).alias("bucket"))


@query(f"SELECT event_id, CASE {' '.join(f'WHEN y < {e} THEN {i - 1}' if i else f'WHEN y < {e} THEN NULL' for i, e in enumerate(rows.ROW_EDGES))} END::INTEGER AS row_id FROM (SELECT event_id, value / 100.0 y FROM events) WHERE y >= {rows.ROW_EDGES[0]} AND y < {rows.ROW_EDGES[-1]}")
def fixed_row_numbers(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "value")
    return rows.fixed_rows(e, F.col("value") / 100.0).select("event_id", "row_id")


def chart_words(spark: SparkSession, d: str) -> DataFrame:
    """Positioned words that print the charts of chart_raw, with a header row a file."""
    t = table(spark, d, "chart_raw").withColumnsRenamed({"percent_change": "percent"})
    body = t.select("src_file", "pos", *[F.coalesce(c, F.lit("")).alias(c) for c in RAW_COLUMNS[1:]])
    head = t.select("src_file").distinct().select("src_file", F.lit(-1).cast("bigint").alias("pos"), *[F.lit(c).alias(c) for c in RAW_COLUMNS[1:]])
    edges = rows.COLUMN_EDGES
    cells = []
    for i, c in enumerate(RAW_COLUMNS[1:]):
        # song and artist share the third column, one above the other
        col = i if i < 3 else i - 1
        x0, x1 = edges[col] + 0.002, edges[col + 1] - 0.002
        top = {"song": 0.0, "artist": 0.012}.get(c, 0.006)
        cells.append(F.struct(F.lit(i).alias("ord"), F.col(c).alias("text"), F.lit(x0).alias("x0"), F.lit(top).alias("dy"), F.lit(x1).alias("x1")))
    w = body.unionByName(head).select("src_file", "pos", F.explode(F.array(*cells)).alias("w")).filter("w.text <> ''")
    # song and artist stand word by word; before every third rank a stray word is read, of which the last counts
    stray = (F.col("w.ord") == 0) & (F.col("pos") % 3 == 0)
    texts = F.when(F.col("w.ord").isin(2, 3), F.filter(F.split("w.text", " "), lambda x: x != "")).otherwise(F.when(stray, F.array(F.lit("~"), F.col("w.text"))).otherwise(F.array("w.text")))
    w = w.select("src_file", "pos", "w", F.size(texts).alias("n"), F.posexplode(texts).alias("k", "text"))
    y = (F.col("pos") + 1) * 0.05 + F.col("w.dy")
    part = (F.col("w.x1") - F.col("w.x0")) / F.col("n")
    x0, x1 = F.col("w.x0") + part * F.col("k"), F.col("w.x0") + part * (F.col("k") + 1)
    # the height of half of the images is known
    height = F.when(F.pmod(F.xxhash64("src_file"), F.lit(2)) == 0, 1000).cast("int")
    return w.select(F.col("src_file").alias("file_name"), height.alias("image_height"), ((F.col("pos") + 1) * 5000 + F.col("w.ord") * 200 + F.col("k")).cast("int").alias("ord"), "text", x0.alias("x0"), y.alias("y0"), x1.alias("x1"), (y + 0.006).alias("y1"))


_PRINTED = {c: f"array_to_string(list_filter(string_split(coalesce({c}, ''), ' '), lambda x: x <> ''), ' ')" for c in ("song", "artist")}


@query(
    f"""SELECT src_file, dense_rank() OVER (PARTITION BY src_file ORDER BY pos) - 1 pos, regexp_replace(regexp_extract(src_file, '\\d{{4}}-\\d{{2}}-\\d{{2}}_\\d+'), '^\\d\\d(\\d\\d)-(\\d\\d)-(\\d\\d)_\\d+$', '\\2/\\3/\\1') chart_date,
    {', '.join(f'{_PRINTED[c]} {c}' if c in _PRINTED else f'coalesce("{"percent_change" if c == "percent" else c}", {chr(39) * 2}) "{c}"' for c in RAW_COLUMNS[1:])} FROM chart_raw"""
)
def reconstructed_tables(spark: SparkSession, d: str) -> DataFrame:
    return rows.reconstruct_table(chart_words(spark, d))


@query("SELECT src_file, row_number() OVER (PARTITION BY src_file ORDER BY pos, k) - 1 AS ord, text FROM (SELECT src_file, pos, 0 k, song text FROM chart_raw UNION ALL SELECT src_file, pos, 1, artist FROM chart_raw)")
def flattened_documents(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "chart_raw")
    box = F.array(F.array(F.lit(0.1), F.lit(0.1)), F.array(F.lit(0.2), F.lit(0.2)))
    line = F.struct(F.array(*[F.struct(F.col(c).alias("value"), box.alias("geometry")) for c in ("song", "artist")]).alias("words"))
    page = F.struct(F.array(F.struct(F.transform(F.array_sort(F.collect_list(F.struct("pos", line.alias("l")))), lambda x: x["l"]).alias("lines"))).alias("blocks"))
    docs = t.groupBy("src_file").agg(page.alias("p")).select("src_file", F.array("p").alias("pages"))
    return files.flatten_document(docs).select("src_file", "ord", "text")


# --- distinct values, counts, joins


_VALID = f"NOT {blank_sql('song')} AND NOT {blank_sql('artist')}"
_LIKELY = " AND ".join(f"NOT regexp_matches(lower({c}), '{FURNITURE}') AND length({strip_sql(c)}) >= 2 AND NOT regexp_full_match({strip_sql(c)}, '[0-9]+')" for c in ("song", "artist"))


@query(f"SELECT song, artist, min(raw_id) AS first, count(*) AS n FROM chart_raw WHERE {_VALID} AND {_LIKELY} GROUP BY song, artist")
def distinct_songs(spark: SparkSession, d: str) -> DataFrame:
    return counts.distinct_songs(table(spark, d, "chart_raw"), "raw_id")


@query(f"SELECT row_id, {_VALID} AS valid, coalesce({_LIKELY}, false) AS likely FROM chart_template")
def valid_rows(spark: SparkSession, d: str) -> DataFrame:
    s, a = F.col("song"), F.col("artist")
    return counts.split_valid(table(spark, d, "chart_template")).select("row_id", "valid", F.coalesce(likely_song(s, a), F.lit(False)).alias("likely"))


@query("SELECT market, artist AS mode, n FROM (SELECT market, artist, count(*) n, row_number() OVER (PARTITION BY market ORDER BY count(*) DESC, min(raw_id)) k FROM chart_raw WHERE artist IS NOT NULL GROUP BY market, artist) WHERE k = 1")
def mode_spelling(spark: SparkSession, d: str) -> DataFrame:
    return counts.mode_of(table(spark, d, "chart_raw").filter("artist is not null"), ["market"], "artist", "raw_id")


@query("SELECT artist, count(*) AS n FROM chart_template GROUP BY artist ORDER BY n DESC, artist LIMIT 5")
def top_artists(spark: SparkSession, d: str) -> DataFrame:
    return counts.top_counts(table(spark, d, "chart_template"), "artist", 5)


_P = "count(DISTINCT {a} || chr(1) || {b})"


@query(f"SELECT count(*) AS rows, {_P.format(a='song', b='artist')} pairs_before, {_P.format(a='lower(song)', b='lower(artist)')} pairs_after, ({_P.format(a='song', b='artist')} - {_P.format(a='lower(song)', b='lower(artist)')}) / {_P.format(a='song', b='artist')} * 100.0 saved_percent FROM chart_template")
def spelling_summary(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "chart_template").select("song", "artist")
    return counts.standardization_summary(t, t.select(F.lower("song").alias("song"), F.lower("artist").alias("artist")))


_PAIRS = f"SELECT DISTINCT {hash_sql('song', 'artist')} combo_hash FROM song_entries WHERE {_VALID}"
_CACHE = f"SELECT {hash_sql('title', 'artist_credit')} combo_hash, min(recording_id) recording_id FROM catalogue GROUP BY 1"


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "song_entries").filter(valid_pair(F.col("song"), F.col("artist")))
    return e.groupBy(hash_of(F.col("song"), F.col("artist")).alias("combo_hash")).agg(F.min(F.struct("song", "artist")).alias("p")).select("combo_hash", "p.*")


def _cache(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "catalogue").groupBy(hash_of(F.col("title"), F.col("artist_credit")).alias("combo_hash")).agg(F.min("recording_id").alias("recording_id"))


@query(f"SELECT combo_hash FROM ({_PAIRS}) WHERE combo_hash NOT IN (SELECT combo_hash FROM ({_CACHE}))")
def unresolved_pairs(spark: SparkSession, d: str) -> DataFrame:
    cache = _cache(spark, d)
    return resolve.to_resolve(_pairs(spark, d), cache, cache).select("combo_hash")


@query(f"SELECT p.combo_hash, recording_id, recording_id IS NOT NULL AS hit FROM ({_PAIRS}) p LEFT JOIN ({_CACHE}) c ON p.combo_hash = c.combo_hash")
def cache_hits(spark: SparkSession, d: str) -> DataFrame:
    return resolve.with_cache(_pairs(spark, d), _cache(spark, d)).select("combo_hash", "recording_id", "hit")


# --- similarity and standard spellings

_SAME = "SELECT a.recording_id ia, b.recording_id ib, a.title ta, b.title tb FROM catalogue a JOIN catalogue b ON a.artist_credit = b.artist_credit AND a.recording_id < b.recording_id"


def _title_pairs(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "catalogue")
    a = c.select(F.col("recording_id").alias("ia"), F.col("title").alias("ta"), "artist_credit")
    b = c.select(F.col("recording_id").alias("ib"), F.col("title").alias("tb"), "artist_credit")
    return a.join(b, "artist_credit").filter("ia < ib").select("ia", "ib", "ta", "tb")


@query(
    f"""SELECT ia, ib, round((greatest(length(ta), length(tb)) - levenshtein(ta, tb)) / greatest(length(ta), length(tb)) * 100.0, 6) edit,
    round(len(list_intersect(list_distinct(string_split(ta, ' ')), list_distinct(string_split(tb, ' ')))) / len(list_distinct(list_concat(string_split(ta, ' '), string_split(tb, ' ')))) * 100.0, 6) words,
    round(CASE WHEN contains(ta, tb) OR contains(tb, ta) THEN least(length(ta), length(tb)) / greatest(length(ta), length(tb)) * 100.0 ELSE 0.0 END, 6) inside, round({quick_sql('ta', 'tb')}, 6) quick FROM ({_SAME})"""
)
def title_similarity(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("ta"), F.col("tb")
    return _title_pairs(spark, d).select("ia", "ib", *[F.round(f(a, b), 6).alias(n) for n, f in (("edit", sim.edit_similarity), ("words", sim.word_similarity), ("inside", sim.containment), ("quick", sim.quick_similarity))])


_E = f"(0.4 * edit + 0.25 * words + 0.2 * lcs + 0.15 * inside)"


@query(
    f"""WITH t AS (SELECT ia, ib, ta, tb, {strip_sql('lower(ta)')} x, {strip_sql('lower(tb)')} y FROM ({_SAME})), p AS (SELECT *, {compare_sql('x')} p, {compare_sql('y')} q FROM t),
    m AS (SELECT *, CASE WHEN length(p) = 0 OR length(q) = 0 THEN 0.0 ELSE (greatest(length(p), length(q)) - levenshtein(p, q)) / greatest(length(p), length(q)) * 100.0 END edit, list_distinct(list_filter(string_split(p, ' '), lambda w: w <> '')) wp, list_distinct(list_filter(string_split(q, ' '), lambda w: w <> '')) wq,
        ({ratio_sql('p', 'q')}) * (length(p) + length(q)) / 2.0 / greatest(length(p), length(q), 1) lcs, CASE WHEN least(length(p), length(q)) > 0 AND (contains(p, q) OR contains(q, p)) THEN least(length(p), length(q)) / greatest(length(p), length(q)) * 100.0 ELSE 0.0 END inside FROM p),
    w AS (SELECT *, CASE WHEN len(wp) + len(wq) = 0 THEN 0.0 ELSE len(list_intersect(wp, wq)) / len(list_distinct(list_concat(wp, wq))) * 100.0 END words FROM m)
    SELECT ia, ib, round({ratio_sql('ta', 'tb')}, 6) ratio, round(({ratio_sql('ta', 'tb')}) * (length(ta) + length(tb)) / 2.0 / greatest(length(ta), length(tb)), 6) lcs, round(CASE WHEN x = y THEN 100.0 WHEN p = q THEN 95.0 ELSE {_E} END, 6) enhanced FROM w"""
)
def title_ratios(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("ta"), F.col("tb")
    return _title_pairs(spark, d).select("ia", "ib", *[F.round(f(a, b), 6).alias(n) for n, f in (("ratio", sim.ratio), ("lcs", sim.lcs_similarity), ("enhanced", sim.enhanced_similarity))])


@query()
def title_blends(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("ta"), F.col("tb")
    return _title_pairs(spark, d).select("ia", "ib", sim.blended_similarity(a, b).alias("blended"), sim.blended_similarity(a, b, raw=True).alias("blended_raw"))


def _spelled(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chart_raw").select("raw_id", "song", "artist")


_RAW = "r0 AS (SELECT raw_id, song, artist FROM chart_raw)"


def _artists_sql(src: str, out: str) -> str:
    known = f"{out}_a AS (SELECT * FROM {src} WHERE length(trim(artist)) > 0)"
    return f"{known}, {standard_sql(out + '_m', out + '_a', 'artist', 80)}, {out} AS (SELECT raw_id, song, coalesce(standard, artist) artist FROM {src} LEFT JOIN {out}_m ON artist = variant)"


def _songs_sql(src: str, out: str) -> str:
    known = f"{out}_a AS (SELECT * FROM {src} WHERE length(trim(song)) > 0 AND artist IS NOT NULL)"
    return f"{known}, {standard_sql(out + '_m', out + '_a', 'song', 85, 'artist')}, {out} AS (SELECT raw_id, coalesce(standard, song) song, artist FROM {src} LEFT JOIN {out}_m ON song = variant AND artist = g)"


def _both_sql(src: str, out: str) -> str:
    known = f"{out}_a AS (SELECT *, song || ' | ' || artist w FROM {src} WHERE NOT {blank_sql('song')} AND NOT {blank_sql('artist')}), {out}_b AS (SELECT w, min({{'song': song, 'artist': artist}}) p FROM {out}_a GROUP BY w)"
    joined = f"SELECT s.raw_id, CASE WHEN a.w IS NOT NULL THEN p.song ELSE s.song END song, CASE WHEN a.w IS NOT NULL THEN p.artist ELSE s.artist END artist FROM {src} s LEFT JOIN {out}_a a USING (raw_id) LEFT JOIN {out}_m ON a.w = variant LEFT JOIN {out}_b ON {out}_b.w = standard"
    return f"{known}, {standard_sql(out + '_m', out + '_a', 'w', 85)}, {out} AS ({joined})"


@query(f"WITH RECURSIVE {_RAW}, {_artists_sql('r0', 'r1')} SELECT * FROM r1")
def standard_artists(spark: SparkSession, d: str) -> DataFrame:
    return cluster.standardize_artists(_spelled(spark, d), order="raw_id")


@query(f"WITH RECURSIVE {_RAW}, {_songs_sql('r0', 'r1')} SELECT * FROM r1")
def standard_songs(spark: SparkSession, d: str) -> DataFrame:
    return cluster.standardize_songs(_spelled(spark, d), order="raw_id")


@query(f"WITH RECURSIVE {_RAW}, {_both_sql('r0', 'r1')} SELECT * FROM r1")
def standard_pairs(spark: SparkSession, d: str) -> DataFrame:
    return cluster.standardize_pairs(_spelled(spark, d), order="raw_id")


@query(f"WITH RECURSIVE {_RAW}, {_artists_sql('r0', 'r1')}, {_songs_sql('r1', 'r2')}, {_both_sql('r2', 'r3')} SELECT * FROM r3")
def standard_all(spark: SparkSession, d: str) -> DataFrame:
    return cluster.standardize(_spelled(spark, d), order="raw_id")


# --- resolving against answers


def _answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers of a search by the first three letters of the title, recordings in order of their id."""
    pairs = _pairs(spark, d).withColumn("k", F.substring(F.lower("song"), 1, 3))
    credit = F.array(F.struct(F.struct(F.col("artist_credit").alias("name")).alias("artist"), F.lit(None).cast("string").alias("literal")))
    rec = F.struct(F.col("recording_id").alias("id"), "title", credit.alias("artist-credit"))
    found = table(spark, d, "catalogue").groupBy(F.substring(F.lower("title"), 1, 3).alias("k")).agg(F.array_sort(F.collect_list(rec)).alias("recordings"))
    return pairs.join(found, "k").drop("k")


_CAND = f"""SELECT combo_hash, song, artist, idx, id, title, credit, {quick_sql('song', 'title')} ss, {quick_sql('artist', 'credit')} sa FROM (
    SELECT p.*, c.recording_id id, c.title, c.artist_credit credit, row_number() OVER (PARTITION BY p.combo_hash ORDER BY c.recording_id) - 1 idx FROM (
        SELECT {hash_sql('song', 'artist')} combo_hash, min({{'song': song, 'artist': artist}}).song song, min({{'song': song, 'artist': artist}}).artist artist FROM song_entries WHERE {_VALID} GROUP BY 1) p
    JOIN catalogue c ON left(lower(p.song), 3) = left(lower(c.title), 3)) WHERE idx < 25"""
_BEST = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY combo_hash ORDER BY score DESC, idx) k FROM (SELECT *, {COMBINED_SQL} score FROM ({_CAND})) WHERE score > 0) WHERE k = 1"""


@query(f"SELECT combo_hash, id AS c_id, round(ss, 6) song_score, round(sa, 6) artist_score, round(score, 6) score, ss >= 75 AND sa >= 75 AND score >= 60 AS accepted, list_filter([CASE WHEN ss < 75 THEN 'song' END, CASE WHEN sa < 75 THEN 'artist' END, CASE WHEN score < 60 THEN 'combined' END], lambda x: x IS NOT NULL) reasons FROM ({_BEST})")
def resolved_answers(spark: SparkSession, d: str) -> DataFrame:
    r = resolve.resolve_answers(_answers(spark, d))
    return r.select("combo_hash", "c_id", *[F.round(c, 6).alias(c) for c in ("song_score", "artist_score", "score")], "accepted", "reasons")


@query(
    f"""WITH c AS (SELECT *, {COMBINED_SQL} score FROM ({_CAND})), e AS (SELECT *, min(CASE WHEN idx >= 10 AND score >= 90 OR idx >= 15 AND score >= 75 THEN idx END) OVER (PARTITION BY combo_hash) stop FROM c),
    b AS (SELECT *, row_number() OVER (PARTITION BY combo_hash ORDER BY score DESC, idx) k FROM e WHERE score > 0 AND (stop IS NULL OR idx <= stop)) SELECT combo_hash, id AS c_id, round(score, 6) score, ss >= 75 AND sa >= 75 AND score >= 60 AS accepted FROM b WHERE k = 1"""
)
def resolved_early_stop(spark: SparkSession, d: str) -> DataFrame:
    return resolve.resolve_answers(_answers(spark, d), early=True).select("combo_hash", "c_id", F.round("score", 6).alias("score"), "accepted")


@query(
    f"""WITH c AS (SELECT combo_hash, idx, id, lower(song) s, lower(title) t, lower(artist) a, lower(credit) c FROM ({_CAND}) WHERE idx < 3), r AS (SELECT combo_hash, idx, id, (({ratio_sql('s', 't')}) + ({ratio_sql('a', 'c')})) / 2 score FROM c),
    b AS (SELECT *, row_number() OVER (PARTITION BY combo_hash ORDER BY score DESC, idx) k FROM r WHERE score > 0) SELECT combo_hash, id AS c_id, round(score, 6) score, score >= 85 AS accepted FROM b WHERE k = 1"""
)
def resolved_strictly(spark: SparkSession, d: str) -> DataFrame:
    return resolve.resolve_strict(_answers(spark, d)).select("combo_hash", "c_id", F.round("score", 6).alias("score"), "accepted")


@query(f"SELECT t::DOUBLE AS threshold, count(*) AS pairs, count(*) FILTER (ss >= t AND sa >= t AND score >= 60) AS accepted FROM ({_BEST}), (SELECT unnest([65, 75, 85]) t) GROUP BY t")
def threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    best = resolve.best_candidate(resolve.score_candidates(resolve.candidates(_answers(spark, d))), "combo_hash")
    return resolve.threshold_sweep(best, [65, 75, 85])


@query(f"SELECT count(*) AS pairs, count(*) FILTER (ok) AS accepted, count(*) FILTER (NOT ok) AS failed, count(*) FILTER (ok) / count(*) * 100.0 AS success_percent FROM (SELECT ss >= 75 AND sa >= 75 AND score >= 60 ok FROM ({_BEST}))")
def match_report(spark: SparkSession, d: str) -> DataFrame:
    return counts.match_report(resolve.resolve_answers(_answers(spark, d)))


@query(f"WITH r AS (SELECT combo_hash, title, credit, id FROM ({_BEST}) WHERE ss >= 75 AND sa >= 75 AND score >= 60) SELECT entry_id, coalesce(title, song) song, coalesce(credit, artist) artist, coalesce(id, '') mbid FROM song_entries LEFT JOIN r ON {hash_sql('song', 'artist')} = combo_hash")
def canonical_names(spark: SparkSession, d: str) -> DataFrame:
    return resolve.apply_names(table(spark, d, "song_entries"), resolve.resolve_answers(_answers(spark, d)), mbid=True).select("entry_id", "song", "artist", "mbid")


_FIRST = "WITH p AS (SELECT combo_hash, song, artist, idx, title, credit, count(*) OVER (PARTITION BY combo_hash) n, count(*) FILTER (lower(title) = lower(song)) OVER (PARTITION BY combo_hash) same FROM ({0}))"


@query(
    f"""{_FIRST.format(_CAND.replace('WHERE idx < 25', ''))}, q AS (SELECT *, {search_sql('song')} qs, {search_sql('artist')} qa FROM p WHERE idx = 0), g AS (SELECT *, ({quick_sql('qs', 'title')} + {quick_sql('qa', 'credit')}) / 2 quick FROM q)
    SELECT combo_hash, CASE WHEN same > 0 THEN 1 ELSE 5 END::INTEGER strategy, CASE WHEN same > 0 THEN same ELSE n END::INTEGER found FROM g WHERE same > 0 OR quick >= 35"""
)
def chosen_answers(spark: SparkSession, d: str) -> DataFrame:
    a = _answers(spark, d)
    same = F.filter("recordings", lambda r: F.lower(r["title"]) == F.lower(F.col("song")))
    tries = a.withColumn("recordings", same).withColumn("strategy", F.lit(1)).unionByName(a.withColumn("strategy", F.lit(5)))
    return resolve.choose_answers(tries).select("combo_hash", "strategy", F.size("recordings").alias("found"))


# --- posts, files, events

_MONTHS = r"'^\w{3} (\w{3} \d{2} \d{2}:\d{2}:\d{2}) [+-]\d{4} (\d{4})$'"
_POSTED = rf"try_strptime(regexp_replace(CASE WHEN regexp_matches(created_at, {_MONTHS}) THEN created_at END, {_MONTHS}, '\1 \2'), '%b %d %H:%M:%S %Y')"
_ANNOUNCED = r"try_strptime(regexp_replace(nullif(regexp_extract(full_text, '(?i)chart dated [A-Za-z]+ \d{1,2}[a-z]{2}, \d{4}'), ''), '(?i)^chart dated ([A-Za-z]+) (\d{1,2})[a-z]{2}, (\d{4})$', '\1 \2 \3'), '%B %d %Y')::DATE"
_IMAGES = f"""SELECT id, posted, chart_date, media[nr].url url, strftime(coalesce(chart_date, posted::DATE), '%Y-%m-%d') || '_' || nr || '.jpg' file_name
    FROM (SELECT id, {_POSTED} posted, {_ANNOUNCED} chart_date, media, unnest(range(1, len(media) + 1)) nr FROM posts) WHERE posted >= TIMESTAMP '2023-08-10' AND media[nr].type = 'photo' AND media[nr].url IS NOT NULL"""


@query(f"SELECT id, {_POSTED} posted, {_ANNOUNCED} chart_date FROM posts")
def post_dates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "posts").select("id", posted_at(F.col("created_at")).cast("timestamp_ntz").alias("posted"), announced_date(F.col("full_text")).alias("chart_date"))


@query(f"SELECT id, url, file_name FROM ({_IMAGES})")
def post_images(spark: SparkSession, d: str) -> DataFrame:
    return posts.image_files(table(spark, d, "posts")).select("id", "url", "file_name")


@query(f"SELECT id, file_name FROM (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY posted, id, url) k FROM ({_IMAGES})) WHERE k = 1 AND file_name NOT IN (SELECT regexp_extract(src_file, '[^/]+$') FROM chart_captions)")
def files_to_fetch(spark: SparkSession, d: str) -> DataFrame:
    present = table(spark, d, "chart_captions").select(F.element_at(F.split("src_file", "/"), -1).alias("file_name"))
    return posts.new_files(posts.image_files(table(spark, d, "posts")), present).select("id", "file_name")


@query(f"SELECT max(posted) newest, min(posted) oldest, arg_min(id, {{'p': posted, 'i': id}}) oldest_id FROM (SELECT id, {_POSTED} posted FROM posts) WHERE posted >= TIMESTAMP '2023-08-10'")
def post_cursor(spark: SparkSession, d: str) -> DataFrame:
    c = posts.next_cursor(table(spark, d, "posts"))
    return c.select(F.col("newest").cast("timestamp_ntz").alias("newest"), F.col("oldest").cast("timestamp_ntz").alias("oldest"), "oldest_id")


@query(r"SELECT DISTINCT src_file, try_cast(regexp_extract(src_file, '(\d{4}-\d{2}-\d{2})_\d+\.jpg$', 1) AS DATE) AS date, strftime(try_cast(regexp_extract(src_file, '(\d{4}-\d{2}-\d{2})_\d+\.jpg$', 1) AS DATE), '%b %y') AS month FROM chart_raw")
def image_folders(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "chart_raw").select("src_file").distinct().withColumn("file_name", F.element_at(F.split("src_file", "/"), -1))
    return files.file_targets(f).select("src_file", "date", "month")


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def event_windows(spark: SparkSession, d: str) -> DataFrame:
    w = windowed_counts(table(spark, d, "events"), "ts")
    return w.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))
