"""Loading delimited records: typed rows apart from failed ones with reason and offset."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIELDS = (
    "chart_date", "rank", "change", "song", "artist", "points", "percent_change", "peak",
    "weeks_on_chart", "sales", "sales_percent", "streams", "streams_percent", "airplay", "airplay_percent", "units",
)
#: States: at the start of a field, in a bare field, in a quoted field, at a quote within one, failed.
START, BARE, QUOTED, CLOSED, FAILED = range(5)
#: Classes of bytes: any other, quote, comma, end of record.
OTHER, QUOTE, COMMA, END = range(4)
STEP = np.array(
    [
        [BARE, QUOTED, START, START],
        [BARE, FAILED, START, START],
        [QUOTED, CLOSED, QUOTED, START],
        [FAILED, QUOTED, START, START],
        [FAILED, FAILED, FAILED, START],
    ],
    dtype=np.uint8,
)
CLASS = np.zeros(256, np.uint8)
CLASS[ord('"')], CLASS[ord(",")] = QUOTE, COMMA


def automaton_states(classes: np.ndarray, chunk: int = 256) -> np.ndarray:
    """The state after each byte, for a buffer of byte classes that starts at a field's start.

    The buffer is cut into chunks of equal length, whatever the records' borders. Pass 1
    runs all chunks at once from every possible state, which gives each chunk's transition
    (state -> state); composing these gives every chunk's true first state; pass 2 runs
    all chunks once more from there.
    """
    n = len(classes)
    m = -(-n // chunk) if n else 0
    grid = np.full(m * chunk, OTHER, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(m, chunk).T)
    to = np.repeat(np.arange(5, dtype=np.uint8)[None, :], m, axis=0)
    for column in grid:
        to = STEP[to, column[:, None]]
    first, state = np.empty(m, np.uint8), START
    for i, t in enumerate(to.tolist()):
        first[i], state = state, t[state]
    out = np.empty_like(grid)
    for j, column in enumerate(grid):
        first = out[j] = STEP[first, column]
    return out.T.reshape(-1)[:n]


def tokenize(lines: list[str | None], width: int = len(FIELDS)) -> tuple[list[str | None], list[int | None], list[list[str] | None]]:
    """(reason, byte offset, fields) of each record: 'quoting', 'columns', 'blank', or None with its fields."""
    raw = []
    for x in lines:
        x = (x or "").removeprefix("﻿")
        raw.append(x.removesuffix("\r").encode())
    n = len(raw)
    length = np.fromiter(map(len, raw), np.int64, n)
    ends = np.cumsum(length + 1) - 1  # of each record, the place of its end mark
    starts = ends - length
    buffer = b"\n".join(raw) + b"\n" if n else b""
    classes = CLASS[np.frombuffer(buffer, np.uint8)]
    classes[ends] = END
    states = automaton_states(classes)
    before = np.empty_like(states)
    if n:
        before[0], before[1:] = START, states[:-1]
    place = np.arange(len(states))
    failed = np.minimum.reduceat(np.where(states == FAILED, place, len(states)), starts) if n else np.empty(0, np.int64)
    is_comma = (classes == COMMA) & (before != QUOTED) & (before != FAILED)
    commas = np.flatnonzero(is_comma)
    low = np.searchsorted(commas, starts)
    count = np.searchsorted(commas, ends) - low
    open_end = before[ends] == QUOTED if n else np.empty(0, bool)
    reasons: list[str | None] = []
    offsets: list[int | None] = []
    fields: list[list[str] | None] = []
    for i, line in enumerate(raw):
        reason, offset, cells = None, None, None
        if not line.strip():
            reason = "blank"
        elif failed[i] < len(states):
            reason, offset = "quoting", int(failed[i] - starts[i])
        elif open_end[i]:
            reason, offset = "quoting", len(line)
        elif count[i] != width - 1:
            reason = "columns"
            offset = len(line) if count[i] < width - 1 else int(commas[low[i] + width - 1] - starts[i])
        if reason in (None, "columns"):
            cut = [-1, *(commas[low[i] : low[i] + count[i]] - starts[i]).tolist(), len(line)]
            cells = [_field(line[a + 1 : b]) for a, b in zip(cut, cut[1:])]
        reasons.append(reason)
        offsets.append(offset)
        fields.append(cells)
    return reasons, offsets, fields


def _field(x: bytes) -> str:
    s = x.decode()
    return s[1:-1].replace('""', '"') if s[:1] == '"' else s


def _is_header(cells: list[str] | None) -> bool:
    return cells is not None and len(cells) >= 2 and [c.strip().lower() for c in cells[:2]] == ["chart_date", "rank"]


def tokenize_records(df: DataFrame, line: str = "raw_line", keep: tuple[str, ...] = ("line_id", "src_file", "line_no")) -> DataFrame:
    """`keep`, kind ('record', 'header', 'blank'), reason ('quoting', 'columns', null), offset (bytes), fields of each line.

    A quote-aware automaton runs over the bytes of a whole Arrow batch at once (see
    automaton_states), so one very long record costs as much a byte as many short ones.
    A header is a line whose first two fields are Chart_Date and Rank; null lines are blank.
    """
    keep = tuple(k for k in keep if k in df.columns)
    schema = T.StructType([df.schema[k] for k in keep] + [T.StructField("kind", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("fields", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            reasons, offsets, fields = tokenize(b.column(len(keep)).to_pylist())
            kinds = ["blank" if r == "blank" else "header" if _is_header(c) else "record" for r, c in zip(reasons, fields)]
            plain = [None if k != "record" else r for r, k in zip(reasons, kinds)]
            offsets = [o if r else None for o, r in zip(offsets, plain)]
            fields = [c if k == "record" and r is None else None for c, k, r in zip(fields, kinds, plain)]
            made = [pa.array(kinds, pa.string()), pa.array(plain, pa.string()), pa.array(offsets, pa.int64()), pa.array(fields, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *made], names=[*keep, "kind", "reason", "offset", "fields"])

    return df.select(*keep, F.col(line).cast("string").alias("__line")).mapInArrow(run, schema)


def load_records(df: DataFrame, line: str = "raw_line") -> DataFrame:
    """Typed records and failed lines of raw chart exports, one row per line that is neither blank nor a header.

    Columns: line_id, src_file, line_no (as far as present); reason, null for a valid
    line, else the first that applies of 'quoting', 'columns', 'value'; offset, the byte
    (after a byte order mark) or for 'value' the number of the field at fault; and the 16
    fields: chart_date date, rank int, change, song, artist string, the figures double,
    null in failed lines. A figure or date that can't be read is null; it isn't a failure.

    Cases: null, empty and white lines are left out, as are headers; a header is known
    by its first two fields, also in mid-file, quoted, or after a byte order mark. A
    carriage return at the end is dropped; line breaks within quotes are content.
    Repeated lines stay. An empty table gives an empty table. Other columns are left out.
    """
    t = tokenize_records(df, line)
    f = {name: F.get(F.col("fields"), F.lit(i)) for i, name in enumerate(FIELDS)}
    blanks = r"^[\s ]+|[\s ]+$"
    rank, change = F.regexp_replace(f["rank"], blanks, ""), F.regexp_replace(f["change"], blanks, "")
    rank_ok, change_ok = rank.rlike(r"^0*([1-9][0-9]?|100)$"), change.rlike(r"(?i)^(|new|re|[+-]?[0-9]{1,2})$")
    bad = F.col("reason").isNull() & ~(rank_ok & change_ok)
    reason = F.when(bad, "value").otherwise(F.col("reason"))
    good = reason.isNull()
    number = lambda c: F.regexp_replace(c, r"[\s ,]", "").try_cast("double")
    typed = {
        "chart_date": F.coalesce(*[F.try_to_date(F.trim(f["chart_date"]), p) for p in ("dd-MM-yy", "yyyy-MM-dd")]),
        "rank": rank.try_cast("int"), "change": F.upper(change), "song": f["song"], "artist": f["artist"],
    }
    typed |= {name: number(c) for name, c in f.items() if name not in typed}
    kept = [c for c in t.columns if c not in ("kind", "reason", "offset", "fields")]
    offset = F.when(bad & ~rank_ok, F.lit(1)).when(bad, F.lit(2)).otherwise(F.col("offset"))
    return t.filter("kind = 'record'").select(*kept, reason.alias("reason"), offset.cast("bigint").alias("offset"), *[F.when(good, c).alias(name) for name, c in typed.items()])
