"""Literal frames, renaming and previews."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def from_rows(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """Literal rows as a frame. Goes through Arrow, so that no Python task has to run."""
    names = [field.strip().split()[0] for field in schema.split(",")]
    rows = [tuple(r) for r in rows]
    table = pa.table({name: [row[i] for row in rows] for i, name in enumerate(names)})
    return spark.createDataFrame(table, schema)


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Positional rename of every column."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def head_rows(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """First ``k`` rows by ``order`` (a top-k, not a full sort)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(k)


def tail_rows(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """Last ``k`` rows by ``order``."""
    return df.orderBy(*[F.col(c).desc_nulls_first() for c in order]).limit(k)


def sample_rows(df: DataFrame, keys: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """``n`` rows chosen by a seeded hash of ``keys``; the same rows on every run."""
    pick = F.xxhash64(*[F.col(k) for k in keys], F.lit(seed))
    return df.orderBy(pick, *keys).limit(n)
