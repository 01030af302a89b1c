"""Ordered work inside groups that may be arbitrarily large.

``Window.partitionBy(key).orderBy(ts)`` puts a whole key into one task. When a single key can hold a
third of all rows that task never ends. The functions here carry values through a hierarchy instead:

1. Rows are dealt to *parts* by ranges of (keys, order). Spark draws the bounds of the ranges from the
   rows themselves, so parts are of similar size whatever the values look like: a billion rows of one
   key, of one date, or between 1.000 and 1.001 are split as well as others. Parts follow the order.
2. A window works inside (part, key).
3. Only a key that crosses the bound of two parts has anything to carry, and a bound is crossed by one
   key at most. So the summaries of such keys are at most two rows per part; a window over these few
   rows carries them along, and they are broadcast back.

Parts are written once (``staged``), so ranges, summaries and rows agree on every attempt. Data that
fit one part need no third step. Results equal those of the plain window, rows with a NULL key or a NULL
order value included: NULL is a key like others and comes first along an ascending order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.operators.staging import staged

PART = "_part"


def ranged(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], parts: int | None = None
) -> tuple[DataFrame, bool]:
    """``df`` with its part along (keys, order) as ``_part``, and whether there are several parts.

    Without ``parts`` there are as many as the session's shuffles have, fewer where data are small.
    """
    by = [*[F.col(k) for k in keys], *order]
    dealt = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
    kept = staged(dealt.withColumn(PART, F.spark_partition_id()))
    return kept, kept.rdd.getNumPartitions() > 1


def _matched(big: DataFrame, few: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join with at most two rows per part, NULL keys matching each other."""
    other = few.withColumnsRenamed({c: f"_on_{c}" for c in on})
    same = [big[c].eqNullSafe(other[f"_on_{c}"]) for c in on]
    return big.join(F.broadcast(other), same, how).drop(*[f"_on_{c}" for c in on])


def _crossing(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of the keys that lie in several parts."""
    if not keys:
        return parts
    several = parts.select(*keys, PART).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("_in"))
    return _matched(parts, several.where("_in > 1").select(*keys), keys, "left_semi")


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column],
    descending: bool = False,
    totals: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """Add running sums, current row included, along ``order`` within ``keys``.

    ``order`` must identify a row within its key; ``sums`` maps each new column to an expression
    without NULLs. ``totals`` adds ``<name>_total``, the sum over the whole key.
    """
    turned = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    dealt, several = ranged(df, keys, turned, parts)
    within = Window.partitionBy(PART, *keys).orderBy(*turned)
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(PART, *keys)
    local = dealt.withColumns({n: F.sum(e).over(so_far) for n, e in sums.items()})
    if totals:
        local = local.withColumns({f"{n}_total": F.sum(e).over(whole) for n, e in sums.items()})
    added = [*sums, *([f"{n}_total" for n in sums] if totals else [])]
    if not several:
        return local.select(*df.columns, *added)
    across = Window.partitionBy(*keys).orderBy(PART)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    later = across.rowsBetween(1, Window.unboundedFollowing)
    summed = _crossing(dealt, keys).groupBy(*keys, PART).agg(*[F.sum(e).alias(f"_sum_{n}") for n, e in sums.items()])
    carried = summed.select(
        *keys,
        PART,
        *[F.sum(f"_sum_{n}").over(earlier).alias(f"_before_{n}") for n in sums],
        *[F.sum(f"_sum_{n}").over(later).alias(f"_after_{n}") for n in sums],
    )
    kinds = {n: local.schema[n].dataType for n in added}
    zero = F.lit(0)

    def with_carry(name: str) -> Column:
        base = name.removesuffix("_total") if name not in sums else name
        out = F.col(name) + F.coalesce(F.col(f"_before_{base}"), zero)
        if name not in sums:
            out = out + F.coalesce(F.col(f"_after_{base}"), zero)
        return out.cast(kinds[name]).alias(name)

    joined = _matched(local, carried, [*keys, PART], "left")
    return joined.select(*df.columns, *[with_carry(n) for n in added])


def with_history(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    position: str = "position",
    parts: int | None = None,
) -> DataFrame:
    """Add rank, previous and first value of ``values`` within ``keys``.

    ``order`` is the ranking column followed by tie-breakers. ``position`` ranks by the first of them,
    ties sharing the lowest rank. ``<v>_prev`` is the value of the preceding row even when NULL;
    ``<v>_first`` is the first value of the group that is not NULL.
    """
    dealt, several = ranged(df, keys, [F.col(c).asc() for c in order], parts)
    by_order = Window.partitionBy(PART, *keys).orderBy(*order)
    whole = by_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def local(frame: DataFrame) -> DataFrame:
        return frame.withColumns(
            {
                position: F.rank().over(Window.partitionBy(PART, *keys).orderBy(order[0])).cast("long"),
                "_row": F.row_number().over(by_order),
                **{f"{v}_prev": F.lag(v).over(by_order) for v in values},
                **{f"{v}_first": F.first(v, ignorenulls=True).over(whole) for v in values},
            }
        )

    added = [position, *[f"{v}_prev" for v in values], *[f"{v}_first" for v in values]]
    if not several:
        return local(dealt).select(*df.columns, *added)
    across = Window.partitionBy(*keys).orderBy(PART)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    all_parts = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summary = local(_crossing(dealt, keys)).groupBy(*keys, PART).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(order[0]).alias("_tail"),
        F.max(position).alias("_tail_rank"),
        *[F.max_by(v, "_row").alias(f"_last_{v}") for v in values],
        *[F.first(f"{v}_first").alias(f"_head_{v}") for v in values],
    )
    # A value that ends one part may go on in the next ones: its rank is that of its first row.
    ahead = summary.withColumn("_ahead", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    began = F.min(F.col("_ahead") + F.col("_tail_rank")).over(Window.partitionBy(*keys, "_tail"))
    carried = ahead.withColumn("_began", began).select(
        *keys,
        PART,
        "_ahead",
        F.lag("_tail").over(across).alias("_tail"),
        F.lag("_began").over(across).alias("_began"),
        *[F.lag(f"_last_{v}").over(across).alias(f"_carry_{v}") for v in values],
        *[F.first(f"_head_{v}", ignorenulls=True).over(all_parts).alias(f"_first_{v}") for v in values],
    )
    goes_on = F.col("_began").isNotNull() & F.col(order[0]).eqNullSafe(F.col("_tail"))
    joined = _matched(local(dealt), carried, [*keys, PART], "left")
    return joined.select(
        *df.columns,
        F.when(goes_on, F.col("_began"))
        .otherwise(F.col(position) + F.coalesce(F.col("_ahead"), F.lit(0)))
        .alias(position),
        *[F.when(F.col("_row") == 1, F.col(f"_carry_{v}")).otherwise(F.col(f"{v}_prev")).alias(f"{v}_prev") for v in values],
        *[F.when(F.col("_ahead").isNotNull(), F.col(f"_first_{v}")).otherwise(F.col(f"{v}_first")).alias(f"{v}_first") for v in values],
    )


def at_ranks(
    counts: DataFrame, keys: Sequence[str], value: str, n: str, wanted: Callable[[Column], Column], parts: int | None = None
) -> DataFrame:
    """The values at wanted ranks of groups given as distinct values with their counts.

    ``wanted`` turns the column of a group's total into an array of structs with the field ``rank``
    (from 0). Returns the keys, ``_total``, ``_wanted`` (the struct) and ``value``.
    """
    summed = running_totals(counts, keys, [value], {"_end": F.col(n)}, totals=True, parts=parts)
    here = F.filter(
        wanted(F.col("_end_total")),
        lambda w: (w["rank"] < F.col("_end")) & (w["rank"] >= F.col("_end") - F.col(n)),
    )
    return summed.select(
        *keys, F.col("_end_total").alias("_total"), F.col(value), F.explode(here).alias("_wanted")
    )


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    parts: int | None = None,
) -> DataFrame:
    """Exact quantiles per group with linear interpolation, one column each.

    The built-in ``percentile`` keeps every distinct value of a group in the memory of one task. Here
    equal values are counted first; the distinct values are dealt to ranges drawn from these counts'
    rows, so that no task sorts more than its range, and running counts find the wanted ranks. NULL
    values and rows with a NULL key are left out, as grouping of data frames does.
    """
    keys = list(keys)
    known = df.where(F.col(value).isNotNull())
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    counts = known.groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))

    def ranks(total: Column) -> Column:
        return F.array(
            *[
                F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), fn(F.lit(float(q)) * (total - 1)).cast("long").alias("rank"))
                for i, q in enumerate(probs.values())
                for side, fn in (("lo", F.floor), ("hi", F.ceil))
            ]
        )

    hits = at_ranks(counts, keys, "_v", "_n", ranks, parts)

    def pick(i: int, side: str) -> Column:
        return F.max(F.when((F.col("_wanted.i") == i) & (F.col("_wanted.side") == side), F.col("_v")))

    edges = hits.groupBy(*keys).agg(
        F.max("_total").alias("_total"),
        *[pick(i, side).alias(f"_{side}{i}") for i in range(len(probs)) for side in ("lo", "hi")],
    )
    out = []
    for i, (name, q) in enumerate(probs.items()):
        h = F.lit(float(q)) * (F.col("_total") - 1)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        out.append((lo + (hi - lo) * (h - F.floor(h))).alias(name))
    return edges.where(F.col("_total").isNotNull()).select(*keys, *out)
