"""General frame operations: dedup, extremes, group values, reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.operators.joins import spread_join
from waybill.operators.ordered import quantiles


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that comes first by ``order`` (a unique order).

    Written as ``min_by``, which combines on the map side, so a key with very
    many rows never lands in one sort.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def argmax_rows(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """All rows attaining the maximum of ``value`` (per group), ties kept."""
    if not by:
        top = df.agg(F.max(value))
        return df.where(F.col(value) == top.scalar())
    top = df.groupBy(*by).agg(F.max(value).alias(value))
    return df.join(top, [*by, value], "left_semi")


def group_values(
    df: DataFrame, keys: Sequence[str], values: dict[str, Column], spread_by: Sequence[str]
) -> DataFrame:
    """Aggregates of the whole group on each of its rows.

    Same result as un-ordered ``over(partitionBy(keys))``, but aggregated first
    and joined back, so that a hot group is spread instead of buffered whole.
    Rows with a NULL key get NULL.
    """
    totals = group_totals(df, keys, values)
    joined = spread_join(df, totals, keys, spread_by, how="left", rows="_rows")
    return joined.select(*df.columns, *values)


def group_totals(df: DataFrame, keys: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """Aggregates per key and the number of rows behind them as ``_rows``."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), *[e.alias(n) for n, e in values.items()]
    )


def impute_group_median(
    df: DataFrame,
    key: str,
    value: str,
    out: str,
    spread_by: Sequence[str],
    reference: DataFrame | None = None,
) -> DataFrame:
    """``value``, or the median of its group where missing.

    Medians come from ``reference`` (default: ``df`` itself), which allows a
    reference period. A group without any value stays NULL.
    """
    medians = quantiles(df if reference is None else reference, [key], value, {"_median": 0.5})
    joined = spread_join(df, medians, [key], spread_by, how="left")
    return joined.withColumn(out, F.coalesce(F.col(value).cast("double"), F.col("_median"))).select(
        *df.columns, out
    )


def lag_diff(
    df: DataFrame, key: Sequence[str], order: str, value: str, k: int = 1, prefix: str = ""
) -> DataFrame:
    """Lag by ``k`` rows, difference and relative change of a period-grain series.

    The window holds one series: at most one row per period.
    """
    w = Window.partitionBy(*key).orderBy(order)
    before = F.lag(value, k).over(w)
    return df.withColumns(
        {
            f"{prefix}lag": before,
            f"{prefix}diff": F.col(value) - before,
            f"{prefix}pct": F.try_divide(F.col(value), before) - 1,
        }
    )


def melt(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "variable", out: str = "value"
) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, out)


def unstack(df: DataFrame, ids: Sequence[str], column: str, levels: Sequence | None, value: Column) -> DataFrame:
    """Long to wide, a column per level that the data hold.

    Naming ``levels`` saves a pass over the data and selects: rows of other levels add no column.
    """
    levels = levels_of(df, column) if levels is None else list(levels)
    return df.groupBy(*ids).pivot(column, levels).agg(value)


def dummies(
    df: DataFrame, column: str, levels: Sequence[str], baseline: str | None, prefix: str | None = None
) -> DataFrame:
    """0/1 column per level except ``baseline``; spaces in names become ``_``."""
    prefix = prefix or column
    kept = [v for v in levels if v != baseline]
    return df.withColumns(
        {
            f"{prefix}_{v.replace(' ', '_')}": F.when(F.col(column) == v, 1).otherwise(0)
            for v in kept
        }
    )


def levels_of(df: DataFrame, column: str) -> list:
    """Distinct values of a category, without NULL, in order. Each is meant to become a column."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    return sorted(r[0] for r in values.collect())


def with_total_row(df: DataFrame, label: str, name: str = "Total") -> DataFrame:
    """Append one row holding the sums of the numeric columns."""
    numeric = [c for c, t in df.dtypes if c != label and not t.startswith(("string", "date"))]
    sums = df.agg(*[F.sum(c).alias(c) for c in numeric])
    total = sums.select(
        *[
            F.lit(name).alias(c)
            if c == label
            else (F.col(c) if c in numeric else F.lit(None).cast(t).alias(c))
            for c, t in df.dtypes
        ]
    )
    return df.unionByName(total)
