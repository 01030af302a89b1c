"""Weighted rendezvous hashing of stable record keys over shards."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 4096
MAX_BLOCKS = 65_536


def rendezvous(keys: Sequence[str], weights: Sequence[float], seed: int = 0) -> Column:
    """The shard of a key: the one with the largest ``weight / -ln(u)``, ``u`` drawn by key and shard.

    A shard's share of the keys is its share of the weights. A key's draws do not depend on the
    number of shards, so a new shard takes keys only into itself and a removed one only gives its
    own away. NULL keys are keys like others; shards of weight 0 get nothing.
    """
    live = [(n, w) for n, w in enumerate(weights) if w > 0]
    if not live or min(weights) < 0:
        raise ValueError("weights must be 0 or more, and one of them positive")
    draws = []
    for n, weight in live:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(n), *[F.col(f"`{k}`") for k in keys]), 11)
        u = (bits + F.lit(0.5)) * F.lit(2.0**-53)
        draws.append(F.struct((F.lit(-float(weight)) / F.ln(u)).alias("score"), F.lit(n).alias("n")))
    return (F.greatest(*draws) if len(draws) > 1 else draws[0])["n"]


def with_slots(df: DataFrame, shard: str, order: Sequence[str], slot: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps.

    A shard is never sorted as one group: rows are dealt to blocks by a hash of ``order``, blocks
    are counted, and a row's number is the sum of the blocks before plus its place in its block.
    Rows equal in ``order`` are numbered in an arbitrary order.
    """
    blocks = min(MAX_BLOCKS, max(1, math.ceil(df.count() / BLOCK_ROWS)))
    dealt = df.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    before = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(shard, "_block")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(shard, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    )
    place = Window.partitionBy(shard, "_block").orderBy(*order)
    return (
        dealt.withColumn("_place", F.row_number().over(place) - 1)
        .join(starts, [shard, "_block"])
        .withColumn(slot, (F.col("_first") + F.col("_place")).cast("long"))
        .drop("_block", "_place", "_first")
    )


def sharded(
    records: DataFrame,
    key: str,
    text: str,
    weights: Sequence[float],
    grown: Sequence[float] | None = None,
    seed: int = 0,
) -> DataFrame:
    """Place of every record: ``key``, size, checksum, law, shard, slot and the shard after growth.

    ``size`` is the UTF-8 bytes of ``text`` plus 1 (NULL: none, so 1). ``law`` is ``key``: key and
    shards alone decide, so records of equal keys share a shard whatever their texts. An empty table
    gives no rows; repeated rows are kept, each with a slot of its own; other columns are ignored.
    """
    raw = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    placed = records.select(
        F.col(f"`{key}`").alias("doc_id"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous([key], weights, seed).cast("int").alias("shard"),
        (rendezvous([key], grown, seed) if grown else F.lit(None)).cast("int").alias("grown_shard"),
    )
    return with_slots(placed, "shard", ["doc_id", "text_crc32"])


def write_shards(records: DataFrame, key: str, weights: Sequence[float], path: str, seed: int = 0) -> None:
    """Write the records as one folder per shard; a shard has as many files as tasks fed it."""
    records.withColumn("shard", rendezvous([key], weights, seed)).write.partitionBy("shard").parquet(path)
