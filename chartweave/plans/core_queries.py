"""Queries of the general data-quality operators and their SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from chartweave.operators.fill import FIELDS, fill_chart_gaps, missing_cells
from chartweave.operators.records import FIELDS as RECORD_FIELDS
from chartweave.operators.records import load_records
from chartweave.operators.spikes import LIMITS, flag_spikes
from chartweave.operators.units import ALIASES, FACTORS, scaled_cells, unify_units
from chartweave.operators.units import FIELDS as UNIT_FIELDS
from chartweave.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return missing_cells(fill_chart_gaps(table(spark, d, "chart_template")))


def p1_filled(spark: SparkSession, d: str) -> DataFrame:
    return fill_chart_gaps(table(spark, d, "chart_template"))


def p1_values(spark: SparkSession, d: str) -> DataFrame:
    """What p1_filled adds, beside row_id."""
    return p1_filled(spark, d).select("row_id", *[f"{f}_{x}" for f in FIELDS for x in ("filled", "method", "distance")])


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return load_records(table(spark, d, "raw_lines")).filter("reason is not null").select("line_id", "reason")


def p2_valid(spark: SparkSession, d: str) -> DataFrame:
    return load_records(table(spark, d, "raw_lines")).filter("reason is null").drop("reason", "offset")


def p2_failed(spark: SparkSession, d: str) -> DataFrame:
    return load_records(table(spark, d, "raw_lines")).filter("reason is not null").select("line_id", "src_file", "line_no", "reason")


def p2_offsets(spark: SparkSession, d: str) -> DataFrame:
    """Where each failed line breaks."""
    return load_records(table(spark, d, "raw_lines")).filter("reason is not null").select("line_id", "reason", "offset")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return scaled_cells(unify_units(table(spark, d, "chart_raw"), table(spark, d, "chart_captions")))


def p5_counts(spark: SparkSession, d: str) -> DataFrame:
    return unify_units(table(spark, d, "chart_raw"), table(spark, d, "chart_captions"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return flag_spikes(table(spark, d, "chart_template")).select("row_id", "field")


def p7_limits(spark: SparkSession, d: str) -> DataFrame:
    """The readings that are flagged by rule, which SQL can say."""
    return p7_flagged(spark, d).filter("reason = 'limit'").select("row_id", "field", "value")


def p7_flagged(spark: SparkSession, d: str) -> DataFrame:
    return flag_spikes(table(spark, d, "chart_template"))


QUERIES = {f.__name__: f for f in (p1_found, p1_filled, p1_values, p2_found, p2_valid, p2_failed, p2_offsets, p5_found, p5_counts, p7_found, p7_flagged, p7_limits)}

_USABLE = r"""coalesce(try_cast(regexp_extract("{f}", '^[^\p{{L}}\p{{N}}\-−–]*([0-9]+)(?:\.0+)?[^\p{{L}}\p{{N}}\-−–]*$', 1) AS INTEGER) BETWEEN 1 AND {hi}, false)"""
P1_SQL = " UNION ALL ".join(f"SELECT row_id, '{f}' AS field FROM chart_template WHERE NOT {_USABLE.format(f=f, hi=hi)}" for f, hi in FIELDS.items())

_F = '(?:"(?:[^"]|"")*"|[^",]*)'
P2_SQL = rf"""WITH l AS (SELECT line_id, regexp_replace(regexp_replace(raw_line, '^\x{{FEFF}}', ''), '\r$', '') t FROM raw_lines WHERE raw_line IS NOT NULL),
d AS (SELECT * FROM l WHERE regexp_matches(t, '\S') AND NOT regexp_matches(t, '(?i)^\s*"?\s*chart_date\s*"?\s*,\s*"?\s*rank\s*"?\s*(,|$)')),
f AS (SELECT *, regexp_extract(t, '(?s)^{_F},({_F}),({_F})(?:,|$)', 1) a, regexp_extract(t, '(?s)^{_F},({_F}),({_F})(?:,|$)', 2) b FROM d),
u AS (SELECT *, regexp_replace(CASE WHEN starts_with(a, '"') THEN replace(substr(a, 2, length(a) - 2), '""', '"') ELSE a END, '^[\s\x{{A0}}]+|[\s\x{{A0}}]+$', '', 'g') r,
    regexp_replace(CASE WHEN starts_with(b, '"') THEN replace(substr(b, 2, length(b) - 2), '""', '"') ELSE b END, '^[\s\x{{A0}}]+|[\s\x{{A0}}]+$', '', 'g') c FROM f),
x AS (SELECT line_id, CASE WHEN NOT regexp_full_match(t, '(?s){_F}(?:,{_F})*') THEN 'quoting' WHEN NOT regexp_full_match(t, '(?s){_F}(?:,{_F}){{15}}') THEN 'columns'
    WHEN NOT (regexp_full_match(r, '0*([1-9][0-9]?|100)') AND regexp_full_match(c, '(?i)(|new|re|[+-]?[0-9]{{1,2}})')) THEN 'value' END reason FROM u)
SELECT line_id, reason FROM x WHERE reason IS NOT NULL"""

P5_SQL = r"""WITH c AS (SELECT src_file, lower(replace(CASE WHEN contains(caption, 'except') THEN split_part(caption, 'except', 2) ELSE regexp_replace(caption, '(\. Other|, the rest).*$', '') END, 'units of', '')) head
    FROM chart_captions WHERE regexp_matches(caption, 'Note:|scan ok|Weekly table|except|the rest as|not scaled')),
x AS (SELECT raw_id, src_file, 'sales' field, sales cell FROM chart_raw UNION ALL SELECT raw_id, src_file, 'streams', streams FROM chart_raw UNION ALL SELECT raw_id, src_file, 'airplay', airplay FROM chart_raw UNION ALL SELECT raw_id, src_file, 'units', units FROM chart_raw)
SELECT raw_id, field FROM x LEFT JOIN c USING (src_file) WHERE regexp_matches(cell, '[0-9]') AND (coalesce(contains(head, field), false)
    OR regexp_matches(regexp_replace(cell, 'copies|plays|sold|units|u\.|streams|listeners|aud\.', '', 'g'), '[^0-9.,''\s\x{A0}]'))"""

_LETTERS = r"regexp_replace(replace(lower(coalesce({c}, '')), 'ß', 'ss'), '[^\p{{L}}\p{{M}}\p{{N}}]+', '', 'g')"
_DAY = r"""try_cast(CASE WHEN length(regexp_extract(chart_date, '([0-9]{1,2})[^0-9]+([0-9]{1,2})[^0-9]+([0-9]{4}|[0-9]{2})', 3)) = 4 THEN '' ELSE '20' END || regexp_replace(regexp_extract(chart_date, '([0-9]{1,2})[^0-9]+([0-9]{1,2})[^0-9]+([0-9]{4}|[0-9]{2})'), '^([0-9]{1,2})[^0-9]+([0-9]{1,2})[^0-9]+([0-9]+)$', '\3-\2-\1') AS DATE)"""


def p7_rule() -> str:
    """A plain rule in SQL that the forest of p7_found is compared with; not its oracle."""
    song = f"array_to_string(list_sort(string_split({_LETTERS.format(c='song')} || {_LETTERS.format(c='artist')}, '')), '')"
    parts = []
    for f, (low, high) in LIMITS.items():
        number = rf"""try_cast(regexp_replace({f}, '[\s\x{{A0}},"'']', '', 'g') AS DOUBLE)"""
        parts.append(
            f"""SELECT row_id, '{f}' AS field FROM (WITH r AS (SELECT row_id, market, {song} s, {_DAY} d, {number} v FROM chart_template),
            ok AS (SELECT *, v BETWEEN {low} AND {high} AND v = floor(v) fine FROM r),
            w AS (SELECT market, s, d, min(v) FILTER (fine) v FROM ok WHERE s <> '' AND d IS NOT NULL GROUP BY 1, 2, 3),
            m AS (SELECT market, greatest(coalesce(1.4826 * quantile_disc(abs(x), 0.5), 0.1), 0.02) sc FROM (SELECT market, ln(v) - lag(ln(v)) OVER (PARTITION BY market, s ORDER BY d) x FROM (SELECT market, s, d, CASE WHEN v IS NOT NULL THEN greatest(v, 0.5) END v FROM w)) GROUP BY market),
            k AS (SELECT *, ln(greatest(v, 0.5)) l FROM w WHERE v IS NOT NULL),
            n AS (SELECT *, lag(v) OVER a bv, lag(d) OVER a bd, lag(l) OVER a b1, lag(l, 2) OVER a b2, lead(l) OVER a a1, lead(l, 2) OVER a a2 FROM k WINDOW a AS (PARTITION BY market, s ORDER BY d)),
            e AS (SELECT *, CASE WHEN b1 IS NULL THEN a2 WHEN a1 IS NULL THEN b2 ELSE b1 END o, sum(CASE WHEN bv = v AND d - bd = 7 THEN 0 ELSE 1 END) OVER (PARTITION BY market, s ORDER BY d) run FROM n),
            g AS (SELECT *, count(*) OVER (PARTITION BY market, s, run) c, greatest(b1, a1, o) hi, least(b1, a1, o) lo FROM e)
            SELECT row_id FROM ok WHERE v IS NOT NULL AND NOT fine UNION
            SELECT row_id FROM ok JOIN g ON ok.market = g.market AND ok.s = g.s AND ok.d = g.d JOIN m ON m.market = g.market
            WHERE ok.fine AND (ln(greatest(ok.v, 0.5)) > hi + 5 * sc OR ln(greatest(ok.v, 0.5)) < lo - 5 * sc OR c >= 4))"""
        )
    return " UNION ALL ".join(parts)


def _p1_values_sql() -> str:
    cell = {f: rf"""try_cast(regexp_extract("{f}", '^[^\p{{L}}\p{{N}}\-−–]*([0-9]+)(?:\.0+)?[^\p{{L}}\p{{N}}\-−–]*$', 1) AS INTEGER)""" for f in FIELDS}
    own = ", ".join(f"CASE WHEN {c} BETWEEN 1 AND {FIELDS[f]} THEN {c} END AS o_{f}" for f, c in cell.items())
    song = f"array_to_string(list_sort(string_split({_LETTERS.format(c='song')} || {_LETTERS.format(c='artist')}, '')), '')"
    seen = lambda f, side: ", ".join(f"last_value(CASE WHEN w_{f} IS NOT NULL THEN {x} END IGNORE NULLS) OVER {side} {side}{k}_{f}" for k, x in (("d", "d"), ("v", f"w_{f}")))
    guesses, out = [], []
    for f, hi in FIELDS.items():
        b, a = f"d - bd_{f}", f"ad_{f} - d"
        nb, na = f"coalesce({b} <= 84, false)", f"coalesce({a} <= 84, false)"
        step = ("round(({b}) / 7.0)", "round(({a}) / 7.0)") if f == "weeks_on_chart" else ("0", "0")
        made = lambda v, m, x: f"{{'v': ({v})::INTEGER, 'm': '{m}', 'x': ({x})::INTEGER}}"
        if f == "peak":
            case = f"WHEN {nb} AND (NOT {na} OR {b} <= {a}) THEN {made(f'bv_{f}', 'carried', b)} WHEN {na} THEN {made(f'av_{f}', 'carried', a)}"
        else:
            line = f"round(bv_{f} + (av_{f} - bv_{f}) * ({b}) / (({b}) + ({a}))::DOUBLE)"
            up, down = f"least(bv_{f} + {step[0].format(b=b)}, {hi})", f"greatest(av_{f} - {step[1].format(a=a)}, 1)"
            case = f"WHEN {nb} AND {na} THEN {made(line, 'interpolated', f'greatest({b}, {a})')} WHEN {nb} THEN {made(up, 'carried', b)} WHEN {na} THEN {made(down, 'carried', a)}"
        guesses.append(f"CASE WHEN w_{f} IS NOT NULL THEN {made(f'w_{f}', 'same_week', '0')} {case} END g_{f}")
        filled = f"coalesce(g_{f}.v, c_{f})"
        if f == "peak":
            filled = f"CASE WHEN {filled} IS NOT NULL THEN least({filled}, o_rank, w_rank) END"
        out += [f"coalesce(o_{f}, {filled}) {f}_filled", f"CASE WHEN o_{f} IS NOT NULL THEN 'observed' WHEN g_{f} IS NOT NULL THEN g_{f}.m WHEN c_{f} IS NOT NULL THEN 'chart_median' ELSE 'none' END {f}_method", f"CASE WHEN o_{f} IS NULL THEN g_{f}.x END {f}_distance"]
    return f"""WITH r AS (SELECT row_id, market, nullif({song}, '') s, {_DAY} - DATE '1970-01-01' d, {own} FROM chart_template),
    w AS (SELECT market, s, d, {', '.join(f'min(o_{f}) w_{f}' for f in FIELDS)} FROM r WHERE s IS NOT NULL AND d IS NOT NULL GROUP BY 1, 2, 3),
    c AS (SELECT market, d, {', '.join(f'quantile_disc(w_{f}, 0.5) c_{f}' for f in FIELDS)} FROM w GROUP BY 1, 2),
    n AS (SELECT *, {', '.join(seen(f, side) for f in FIELDS for side in 'ba')} FROM w
        WINDOW b AS (PARTITION BY market, s ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a AS (PARTITION BY market, s ORDER BY d DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    g AS (SELECT market, s, d, w_rank, {', '.join(guesses)} FROM n)
    SELECT row_id, {', '.join(out)} FROM r LEFT JOIN g ON r.market IS NOT DISTINCT FROM g.market AND r.s = g.s AND r.d = g.d LEFT JOIN c ON r.market IS NOT DISTINCT FROM c.market AND r.d = c.d"""


P7_LIMITS_SQL = " UNION ALL ".join(
    f"""SELECT row_id, '{f}' AS field, v AS value FROM (SELECT row_id, try_cast(regexp_replace({f}, '[\\s\\x{{A0}},"'']', '', 'g') AS DOUBLE) v FROM chart_template) WHERE NOT (v BETWEEN {low} AND {high} AND v = floor(v))"""
    for f, (low, high) in LIMITS.items()
)

# the fields of a valid line: quotes around a field dropped, doubled ones made single
_CELLS = f"""list_transform(regexp_extract_all(t || ',', '({_F}),', 1), lambda x: CASE WHEN starts_with(x, '"') THEN replace(substr(x, 2, length(x) - 2), '""', '"') ELSE x END)"""
_TEXTS = ("song", "artist")


def _p2_valid_sql() -> str:
    bare = r"regexp_replace({c}, '^[\s\x{{A0}}]+|[\s\x{{A0}}]+$', '', 'g')"
    cells = []
    for i, name in enumerate(RECORD_FIELDS, 1):
        c = f"c[{i}]"
        if name == "chart_date":
            cells.append(f"coalesce(try_strptime(CASE WHEN regexp_full_match(trim({c}), '[0-9]{{2}}-[0-9]{{2}}-[0-9]{{2}}') THEN trim({c}) END, '%d-%m-%y'), try_strptime(CASE WHEN regexp_full_match(trim({c}), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN trim({c}) END, '%Y-%m-%d'))::DATE chart_date")
        elif name == "rank":
            cells.append(f"try_cast({bare.format(c=c)} AS INTEGER) rank")
        elif name == "change":
            cells.append(f"upper({bare.format(c=c)}) change")
        elif name in _TEXTS:
            cells.append(f"{c} {name}")
        else:
            cells.append(rf"try_cast(regexp_replace({c}, '[\s\x{{A0}},]', '', 'g') AS DOUBLE) {name}")
    head, _, _ = P2_SQL.partition("SELECT line_id, reason FROM x")
    return f"{head} SELECT line_id, src_file, line_no, {', '.join(cells)} FROM (SELECT line_id, {_CELLS} c FROM x JOIN d USING (line_id) WHERE reason IS NULL) JOIN raw_lines USING (line_id)"


P2_FAILED_SQL = P2_SQL.replace("SELECT line_id, reason FROM x WHERE", "SELECT line_id, src_file, line_no, reason FROM x JOIN raw_lines USING (line_id) WHERE")

def _p5_counts_sql() -> str:
    """The same reading with regular expressions: the longest alias beside the number, else the one the caption links to the field's name."""
    quote = lambda w: re.escape(w.replace("|", " ")).replace("'", "''").replace("\\ ", " ")
    every = sorted((w for ws in ALIASES.values() for w in ws), key=len, reverse=True)
    units = ", ".join(f"('{w.replace('|', ' ').replace(chr(39), chr(39) * 2)}', '{u}', {FACTORS[u]}::BIGINT)" for u, ws in ALIASES.items() for w in ws)
    names = "sales|streams|airplay|units"
    list_ = r"\s*(?:,|;|&|\+|and|und|y|et)(?:\s*(?:and|&|\+))?\s*"
    link = r"\s*(?:,?\s*(?:which|that)?\s*(?:is|are)?\s*(?:all\s+)?(?:given|printed|shown|counted|stated|expressed|listed|reported)?\s*in(?:\s+the)?|/|:|=|\()\s*"
    told = rf"((?:{names})(?:{list_}(?:{names}))*){link}({'|'.join(map(quote, every))})(?:$|[^a-z0-9])"
    space = r"\s\x{A0}\x{2009}\x{202F}"
    number = rf"[0-9](?:[0-9.,''’{space}]*[0-9])?"
    scale = "|".join(quote(w) for w in every if w not in ALIASES["one"])
    after, before = rf"^[ (\t]*({scale})(?:$|[^a-z0-9])", rf"(?:^|[^a-z])({scale})[ .\t]*$"
    cells = " UNION ALL ".join(f"SELECT raw_id, src_file, '{f}' field, {f} cell FROM chart_raw" for f in UNIT_FIELDS)
    marks = "regexp_replace(t, '[^.,]', '', 'g')"
    value = f"""try_cast(CASE WHEN contains({marks}, '.') AND contains({marks}, ',') THEN CASE WHEN right({marks}, 1) = ',' THEN replace(replace(t, '.', ''), ',', '.') ELSE replace(t, ',', '') END
        WHEN length({marks}) = 1 AND (told_in IS NOT NULL OR length(regexp_extract(t, '[.,]([0-9]*)$', 1)) <> 3) THEN replace(t, ',', '.') ELSE regexp_replace(t, '[.,]', '', 'g') END AS DOUBLE)"""
    return rf"""WITH a(alias, unit, factor) AS (VALUES {units}),
    p AS (SELECT src_file, unnest(regexp_extract_all(lower(caption), '{told}')) part FROM chart_captions),
    q AS (SELECT src_file, regexp_extract(part, '{told}', 1) who, regexp_extract(part, '{told}', 2) alias FROM p),
    c AS (SELECT src_file, field, max_by(unit, factor) unit, max(factor) factor FROM (SELECT q.*, unnest(list_filter(['sales', 'streams', 'airplay', 'units'], lambda f: contains(who, f))) field FROM q) JOIN a USING (alias) WHERE unit <> 'one' GROUP BY 1, 2),
    x AS (SELECT *, regexp_extract(cell, '{number}') n FROM ({cells})),
    y AS (SELECT *, lower(substr(cell, strpos(cell, n) + length(n))) tail, lower(left(cell, strpos(cell, n) - 1)) head FROM x),
    z AS (SELECT *, coalesce(nullif(regexp_extract(tail, '{after}', 1), ''), nullif(regexp_extract(head, '{before}', 1), '')) alias FROM y),
    r AS (SELECT raw_id, z.src_file, z.field, cell, regexp_replace(n, '[{space}''’]', '', 'g') t, coalesce(n, '') <> '' has, a.unit own, a.factor f1, c.unit cap, c.factor f2 FROM z LEFT JOIN a ON z.alias = a.alias LEFT JOIN c ON z.src_file = c.src_file AND z.field = c.field),
    t AS (SELECT *, CASE WHEN has AND own IS NOT NULL THEN 'cell' WHEN has AND cap IS NOT NULL THEN 'caption' END told_in FROM r)
    SELECT raw_id, src_file, field, cell, CASE WHEN has THEN coalesce(own, cap, 'one') END unit, told_in, CASE WHEN has THEN coalesce(f1, f2, 1)::BIGINT END factor, round({value} * coalesce(f1, f2, 1)) AS count FROM t"""


SQL: dict[str, str] = {"p5_counts": _p5_counts_sql(), "p1_found": P1_SQL, "p1_values": _p1_values_sql(), "p2_found": P2_SQL, "p2_valid": _p2_valid_sql(), "p2_failed": P2_FAILED_SQL, "p5_found": P5_SQL, "p7_limits": P7_LIMITS_SQL}
