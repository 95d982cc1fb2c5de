"""Drawing documents so that each source holds its target share of all tokens."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartweave.llm.encode import TOKENIZERS, token_counts
from chartweave.session import cut


def sainte_lague(weights: list[float], seats: int) -> list[int]:
    """Seats by the highest quotients weight / (2 k + 1); ties go to the earlier entry. Zero weights get none.

    Starts at the rounded quotas and moves single seats by the quotients, so the cost
    depends on the number of weights, not of seats.
    """
    total = sum(w for w in weights if w > 0)
    if total <= 0 or seats <= 0:
        return [0] * len(weights)
    got = [int(max(w, 0) / total * seats + 0.5) for w in weights]
    give = [(-w / (2 * k + 1), i) for i, (w, k) in enumerate(zip(weights, got)) if w > 0]
    heapq.heapify(give)
    short = seats - sum(got)
    while short > 0:
        _, i = heapq.heappop(give)
        got[i] += 1
        heapq.heappush(give, (-weights[i] / (2 * got[i] + 1), i))
        short -= 1
    take = [(w / (2 * k - 1), -i) for i, (w, k) in enumerate(zip(weights, got)) if k > 0]
    heapq.heapify(take)
    while short < 0:
        _, i = heapq.heappop(take)
        got[-i] -= 1
        if got[-i]:
            heapq.heappush(take, (weights[-i] / (2 * got[-i] - 1), i))
        short += 1
    return got


def fill_quota(tokens: np.ndarray, quota: int) -> np.ndarray:
    """Which of the documents, in their order, are taken: each that still fits into what is left of the quota."""
    taken, left = np.zeros(len(tokens), bool), quota
    for i, n in enumerate(tokens.tolist()):
        if n <= left:
            taken[i] = True
            left -= n
    return taken


def draw_mix(docs: DataFrame, targets: DataFrame, tokenizer: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken", block: int = 256, shard_tokens: int = 8_000_000, most_shards: int = 10_000, seed: int = 17) -> DataFrame:
    """(doc_id, source, tokens, repeats): the documents drawn, each used `repeats` >= 1 times.

    The total is the largest for which every listed source that has tokens can hold its share
    with no document used more than max_repeats times. It is divided into blocks of `block`
    tokens; Sainte-Lague apportionment gives each source its number of blocks by the shares. A
    source takes whole passes over its documents; the blocks of the rest are apportioned to its
    shards by the tokens of documents that fit in, and a shard takes, in the order of a seeded hash, every
    document that still fits into its quota. So no shard exceeds its quota, a document larger than it is passed over,
    and what is missing is less than the shard's smallest document not taken.

    Cases: documents of unlisted or null sources, and those without tokens (null or empty
    text) are not drawn; a listed source without documents gets nothing and the other shares
    keep their proportions (mix_shares reports it). Targets with null or no positive share or
    repeats count as without documents; repeated targets: the largest share and its repeats. Repeated
    rows are drawn each on their own. Empty tables give an empty result. Other columns are left out.

    Plan: tokens are counted once (a table in the shared checkpoint folder, without texts).
    Only the sums per target, a fixed table, reach the driver. A large source is cut into
    shards of about shard_tokens tokens, beyond most_shards of them into larger ones, so a hot source is spread and the
    quotas of a source stay a short list.
    """
    spark = docs.sparkSession
    sized = cut(token_counts(docs.select("doc_id", "source", "text"), tokenizer).filter("tokens > 0 and source is not null"))
    want = targets.filter("target_share > 0 and max_repeats > 0 and source is not null").groupBy("source").agg(F.max(F.struct("target_share", "max_repeats")).alias("t")).select("source", "t.*")
    held = {r["source"]: r for r in want.join(sized.groupBy("source").agg(F.sum("tokens").alias("n")), "source").collect()}
    names = sorted(held)
    total = min((held[s]["n"] * held[s]["max_repeats"] / held[s]["target_share"] for s in names), default=0) * sum(held[s]["target_share"] for s in names)
    blocks = sainte_lague([held[s]["target_share"] for s in names], int(total // block))
    plan = []
    for s, q in zip(names, blocks):
        n, most = held[s]["n"], held[s]["max_repeats"]
        passes = min(q * block // n, most)
        plan.append((s, n, min(most_shards, max(1, -(-n // shard_tokens))), passes, q * block - passes * n if passes < most else 0))
    plan_df = F.broadcast(spark.createDataFrame(plan, "p_source string, all bigint, shards bigint, passes int, rest bigint"))
    rows = sized.join(plan_df, F.col("source") == F.col("p_source"))
    rows = rows.withColumn("order", F.xxhash64("doc_id", F.lit(seed))).withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.col("shards")))
    few = sum(p[2] for p in plan) <= 10_000
    # a document larger than its shard's part of the rest can't be drawn for it and gives the shard no weight
    part = rows.groupBy("source", "shard").agg(F.sum("tokens").alias("held"))
    rows = rows.join(F.broadcast(part) if few else part, ["source", "shard"]).withColumn("fits", F.col("tokens") <= F.col("rest") * F.col("held") / F.col("all"))
    shards = rows.groupBy("source", "shard").agg(F.sum(F.when(F.col("fits"), F.col("tokens")).otherwise(0)).alias("weight"), F.first("rest").alias("rest"))

    def apportion(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("shard")
        seats = sainte_lague(part["weight"].tolist(), int(part["rest"].iloc[0]) // block)
        return pd.DataFrame({"source": part["source"], "shard": part["shard"], "quota": [k * block for k in seats]})

    due = shards.groupBy("source").applyInPandas(apportion, "source string, shard bigint, quota bigint")
    rows = rows.join(F.broadcast(due) if few else due, ["source", "shard"])
    kind = docs.schema["doc_id"].dataType.simpleString()

    def draw(t: pa.Table) -> pa.Table:
        t = t.sort_by([("order", "ascending"), ("doc_id", "ascending"), ("tokens", "ascending")])
        repeats = t["passes"][0].as_py() + fill_quota(t["tokens"].to_numpy(), t["quota"][0].as_py()).astype(np.int32)
        return t.select(["doc_id", "source", "tokens"]).append_column("repeats", pa.array(repeats.astype(np.int32))).filter(pa.array(repeats > 0))

    rows = rows.select("doc_id", "source", "tokens", "order", "shard", "quota", "passes")
    return rows.groupBy("source", "shard").applyInArrow(draw, f"doc_id {kind}, source string, tokens bigint, repeats int")


def mix_shares(drawn: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target: source, target_share, max_repeats, documents, tokens drawn, actual_share (0 for a source without documents) and
    due_share, its part of the target shares of all sources drawn from."""
    got = drawn.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"))
    out = targets.join(got, "source", "left")
    drawn_share = F.when(F.col("tokens").isNotNull(), F.col("target_share"))
    # one row per target, a fixed table
    all_ = out.agg(F.sum("tokens").alias("all_tokens"), F.sum(drawn_share).alias("all_shares"))
    out = out.join(F.broadcast(all_), F.lit(True), "left")
    zero = F.lit(0).cast("bigint")
    return out.select(
        "source", "target_share", "max_repeats", F.coalesce("documents", zero).alias("documents"), F.coalesce("tokens", zero).alias("tokens"),
        F.coalesce(F.col("tokens") / F.col("all_tokens"), F.lit(0.0)).alias("actual_share"), F.coalesce(drawn_share / F.col("all_shares"), F.lit(0.0)).alias("due_share"),
    )
