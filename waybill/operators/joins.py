"""Equi-joins of a large frame with a table of few rows per key when some keys are hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot once it has this many rows on the large side. The list of hot
# keys then has at most rows / HOT_ROWS entries, which bounds its broadcast.
HOT_ROWS = 1_000_000


def spread_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    rows: str | None = None,
    counts: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``big`` to ``small`` (few rows per key, usually one), spreading hot keys.

    Adaptive execution splits a skewed shuffle only if both join inputs are plain
    shuffles; a ``small`` side fresh from an aggregate on the same key is not.
    So a key gets one salt per ``hot_rows`` of its rows, chosen by a hash of
    ``spread_by`` (columns that tell them apart), and its ``small`` rows are repeated
    once per salt. Cold keys have the single salt 0 and are not repeated; in all,
    ``small`` grows by at most rows / ``hot_rows``.

    The number of ``big`` rows of a key, or an upper bound, comes from the column
    ``rows`` of ``small`` or from ``counts`` (``on`` and ``_rows``). Without either
    they are counted, which reads ``big`` twice.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    on = list(on)
    if counts is not None:
        counted = counts
    elif rows is None:
        counted = big.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    else:
        counted = small.select(*on, F.col(rows).alias("_rows"))
        small = small.drop(rows)
    hot = counted.where(F.col("_rows") > hot_rows).select(
        *on, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_parts")
    )
    parts = F.coalesce("_parts", F.lit(1))
    left = big.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*spread_by), parts).cast("int")
    )
    right = small.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), parts - 1))
    )
    return left.drop("_parts").join(right.drop("_parts"), [*on, "_salt"], how).drop("_salt")
