"""Token ids of a whole corpus, with content-defined chunks encoded once and reused."""

from __future__ import annotations

import base64
import os
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"
#: The pre-tokenizer's public pattern: each match is encoded on its own.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WINDOW = 5  # doublings: the rolling hash covers 32 bytes
GEAR = np.random.default_rng(20240229).integers(0, 2**32, 256, dtype=np.uint32)


@cache
def byte_bpe(path: str) -> tiktoken.Encoding:
    """The byte-level BPE whose ranks lie at `path`; without special tokens."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Gear hash of the 32 bytes that end at each position (fewer at the start), by doubling the window."""
    h = GEAR[data]
    for k in range(WINDOW):
        n = 1 << k
        if n >= len(h):
            break
        h[n:] = h[n:] + (h[:-n] << np.uint32(n))
    return h


def cut_points(raw: bytes, mean: int = 1024, reach: int = 256) -> list[int]:
    """Inner chunk borders of a UTF-8 text, defined by content.

    A border is where the rolling hash has its top bits zero (every `mean` bytes on average),
    moved on to the next line end after a non-space if one lies within `reach` bytes (there the
    pre-tokenizer always splits), else to the next character. Borders closer than mean / 4 merge.
    """
    if len(raw) <= mean:
        return []
    data = np.frombuffer(raw, np.uint8)
    bits = int(np.log2(mean))
    hits = np.flatnonzero(rolling_hash(data) >> np.uint32(32 - bits) == 0) + 1
    out, last = [], 0
    for p in hits.tolist():
        if p < last + mean // 4:
            continue
        q = raw.find(b"\n", p, p + reach)
        while q > 0 and not 0x20 < raw[q - 1] < 0x7F:
            q = raw.find(b"\n", q + 1, p + reach)
        if q < 0:
            q = p
            while q < len(raw) and raw[q] & 0xC0 == 0x80:
                q += 1
        if last < q < len(raw):
            out.append(q)
            last = q
    return out


def clean_join(raw: bytes, at: int) -> bool:
    """Whether the pre-tokenizer splits at `at` whatever stands around: a line end after an ASCII non-space."""
    return raw[at : at + 1] == b"\n" and 0x20 < raw[at - 1] < 0x7F


def repair(enc: tiktoken.Encoding, chunks: list[str], ids: list[np.ndarray], lengths: np.ndarray, dirty: list[bool]) -> list[np.ndarray]:
    """Exact ids of the whole text from the ids of its chunks; dirty[i]: the join after chunk i isn't clean.

    The pre-tokenizer scans left to right without memory, so the left chunk's pieces hold
    up to the last that ends three characters before the join; from there pieces are encoded
    anew across the join until one ends where a piece of the right chunk ends. From there on
    the right chunk's ids are exact. lengths: bytes of each token id.
    """
    out: list[np.ndarray] = []
    i, n = 0, len(chunks)
    while i < n:
        j = i
        while j < n - 1 and dirty[j]:
            j += 1
        if j == i:
            out.append(ids[i])
        else:
            out.append(_span(enc, chunks[i : j + 1], ids[i : j + 1], lengths))
        i = j + 1
    return out


def _span(enc: tiktoken.Encoding, chunks: list[str], ids: list[np.ndarray], lengths: np.ndarray) -> np.ndarray:
    pattern = _compiled()
    text = "".join(chunks)
    borders = np.cumsum([0] + [len(c) for c in chunks]).tolist()
    parts: list[np.ndarray] = []
    done = 0  # characters of text whose ids are in parts
    k = 0  # the chunk in which `done` lies
    while done < len(text):
        start, stop = borders[k], borders[k + 1]
        ends = [start + m.end() for m in pattern.finditer(chunks[k])]
        starts = [start, *ends[:-1]] if ends else [start]
        # pieces of this chunk that stand: from `done` (a border of theirs) to three characters before its end
        limit = len(text) if stop == len(text) else stop - 3
        lo = bisect_left(starts, done)
        hi = lo
        while hi < len(ends) and ends[hi] <= limit:
            hi += 1
        upto = ends[hi - 1] if hi > lo else done
        if upto > done:
            size = np.cumsum(lengths[ids[k]])
            base = len(text[start:done].encode())
            a = 0 if base == 0 else int(np.searchsorted(size, base)) + 1
            b = int(np.searchsorted(size, len(text[start:upto].encode()))) + 1
            parts.append(ids[k][a:b])
            done = upto
        if done >= len(text):
            break
        while borders[k + 1] <= done:
            k += 1
        nxt = k + 1
        right = {borders[nxt]} | {borders[nxt] + m.end() for m in pattern.finditer(chunks[nxt])} if nxt < len(chunks) else set()
        for m in pattern.finditer(text, done):
            parts.append(np.array(enc.encode_ordinary(m.group()), np.int64))
            done = m.end()
            while nxt < len(chunks) - 1 and done >= borders[nxt + 1]:
                nxt += 1
                right = {borders[nxt]} | {borders[nxt] + x.end() for x in pattern.finditer(chunks[nxt])}
            if done in right and done >= borders[nxt]:
                break
        k = nxt if nxt < len(chunks) and done < len(text) else k
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


@cache
def _compiled() -> regex.Pattern:
    return regex.compile(PATTERN)


@cache
def token_lengths(path: str) -> np.ndarray:
    enc = byte_bpe(path)
    return np.array([len(enc.decode_single_token_bytes(i)) for i in range(enc.n_vocab)], np.int64)


def encode_corpus(docs: DataFrame, tokenizer: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken", mean: int = 1024) -> DataFrame:
    """(doc_id, ids) of each row: the token ids of its text, without special tokens.

    Null and empty texts give an empty list. Repeated rows and ids stay, one result a row.
    Texts of any length are encoded whole. An empty table gives an empty table; other columns
    are left out. `tokenizer` is the path of the ranks; vocabularies up to 65,536 ids.

    Each text is cut into content-defined chunks (rolling hash); equal chunks, in whatever
    document, are encoded once; the lists of a document's chunks are put together, and joins
    where the pre-tokenizer might not split are repaired by encoding across them until the
    pieces agree again (see repair).

    Plan: the shuffled text is that of distinct chunks as far as a task can tell (map-side
    aggregation). Chunks then meet the list of their places, 40 bytes each, by a merge join,
    whose skewed side AQE splits: a chunk that a third of all documents share is encoded once
    a split. The 2-byte ids are shuffled once, to their document; the ids of one document meet
    in one row, as the result demands.
    """
    if tokenizer.endswith(".json"):
        raise ValueError("the ranks file is needed, not the JSON form")
    keyed = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.col("text").cast("string").alias("text"))

    def pieces(text: str | None) -> Iterator[tuple[bytes, bool]]:
        """(chunk, whether the join after it isn't clean)"""
        raw = (text or "").encode()
        points = cut_points(raw, mean)
        for a, b in zip([0, *points], [*points, len(raw)]):
            yield raw[a:b], b < len(raw) and not clean_join(raw, b)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            uid, doc, seq, h1, h2, dirty, edge = [], [], [], [], [], [], []
            for u, d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                before = False
                for i, (chunk, join) in enumerate(pieces(t)):
                    h = xxhash.xxh3_128_digest(chunk)
                    uid.append(u), doc.append(d), seq.append(i), dirty.append(join), edge.append(join or before)
                    h1.append(int.from_bytes(h[:8], "big", signed=True)), h2.append(int.from_bytes(h[8:], "big", signed=True))
                    before = join
            kinds = (pa.int64(), b.schema.field(1).type, pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((uid, doc, seq, h1, h2, dirty, edge), kinds)], names=["uid", "doc_id", "seq", "h1", "h2", "dirty", "edge"])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # of this task, emptied before it can grow large
        for b in batches:
            rows = []
            for t in b.column(0).to_pylist():
                for chunk, _ in pieces(t):
                    h = xxhash.xxh3_128_digest(chunk)
                    if h not in seen:
                        seen.add(h)
                        rows.append((int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True), chunk.decode()))
            if len(seen) > 500_000:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["h1", "h2", "chunk"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = byte_bpe(tokenizer)
        last, ids = None, b""  # the places of a chunk come one after the other
        for b in batches:
            out, edge = [], []
            for h1, h2, flag, chunk in zip(b.column("h1").to_pylist(), b.column("h2").to_pylist(), b.column("edge").to_pylist(), b.column("chunk").to_pylist()):
                if last != (h1, h2):
                    last, ids = (h1, h2), np.array(enc.encode_ordinary(chunk), np.uint16).tobytes()
                out.append(ids)
                edge.append(chunk if flag else None)
            kept = [b.column(c) for c in ("uid", "doc_id", "seq", "dirty")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(edge, pa.string()), pa.array(out, pa.binary())], names=["uid", "doc_id", "seq", "dirty", "edge", "ids"])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, lengths = byte_bpe(tokenizer), token_lengths(tokenizer)
        for b in batches:
            out = []
            for parts in b.column(1).to_pylist():
                parts.sort(key=lambda p: p["seq"])
                ids = [np.frombuffer(p["ids"], np.uint16) for p in parts]
                if any(p["dirty"] for p in parts):
                    ids = repair(enc, [p["edge"] or "" for p in parts], ids, lengths, [p["dirty"] for p in parts])
                out.append(np.concatenate(ids) if ids else np.empty(0, np.uint16))
            flat = np.concatenate(out).astype(np.int32) if out else np.empty(0, np.int32)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    where = keyed.mapInArrow(places, f"uid bigint, doc_id {kind}, seq int, h1 bigint, h2 bigint, dirty boolean, edge boolean")
    distinct = keyed.select("text").mapInArrow(texts, "h1 bigint, h2 bigint, chunk string").groupBy("h1", "h2").agg(F.any_value("chunk").alias("chunk"))
    # the merge join leaves the places of a chunk together and the texts where the aggregate put them
    placed = where.join(distinct.hint("merge"), ["h1", "h2"])
    coded = placed.mapInArrow(encode, f"uid bigint, doc_id {kind}, seq int, dirty boolean, edge string, ids binary")
    whole = coded.groupBy("uid").agg(F.any_value("doc_id").alias("doc_id"), F.collect_list(F.struct("seq", "dirty", "edge", "ids")).alias("parts"))
    return whole.select("doc_id", "parts").mapInArrow(assemble, f"doc_id {kind}, ids array<int>")


def token_counts(docs: DataFrame, tokenizer: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """The columns of `docs` without text and with tokens, the number of its tokens (bigint; 0 for null and empty texts)."""
    keep = [c for c in docs.columns if c not in ("text", "tokens")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = byte_bpe(tokenizer)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], names=[*keep, "tokens"])

    schema = docs.select(*keep).withColumn("tokens", F.lit(0).cast("bigint")).schema
    return docs.select(*keep, F.col("text").cast("string")).mapInArrow(count, schema)


def tokenizer_path(name: str) -> str:
    """Path of a public tokenizer's file; CHARTWEAVE_TOKENIZERS names another folder."""
    return os.path.join(os.environ.get("CHARTWEAVE_TOKENIZERS", TOKENIZERS), name)
