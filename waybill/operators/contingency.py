"""Contingency tables in long form ``(a, b, n)`` and tests on them.

The facts are counted once per (a, b) with map-side combine; everything after
works on that table. Tests read observed cells only, however many levels there are; tables
that list empty cells have levels x levels rows by definition. Facts that are counted
already pass their count as ``weight``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import chi2_sf, safe_ratio
from waybill.operators.joins import spread_join
from waybill.operators.staging import one_row, staged

# Levels that one row holds while the grid of all cells is made.
LEVEL_BLOCK = 1_000


def pair_counts(df: DataFrame, a: str, b: str, weight: Column | None = None) -> DataFrame:
    """Observed cells only. Rows with a NULL in either column are left out.

    The cells are kept, so that the facts are read once for all that follows.
    """
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    known = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return staged(known.groupBy(a, b).agg(n.alias("n")))


def _filled(counts: DataFrame, a: str, b: str) -> DataFrame:
    """The cells with empty ones as 0: every level of ``a`` with every level of ``b``.

    Levels of ``b`` travel in blocks, so no row holds more than about ``LEVEL_BLOCK`` of them.
    """
    levels = counts.select(b).distinct()
    blocks = levels.agg(F.ceil(F.count(F.lit(1)) / LEVEL_BLOCK).cast("int")).scalar()
    blocks = F.greatest(F.lit(1), blocks)
    packed = levels.groupBy(F.pmod(F.xxhash64(b), blocks).cast("int").alias("_block")).agg(F.collect_list(b).alias("_levels"))
    spread = counts.select(a).distinct().withColumn("_block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    grid = spread.join(packed, "_block").select(a, F.explode("_levels").alias(b))
    return grid.join(counts, [a, b], "left").select(a, b, F.coalesce("n", F.lit(0)).alias("n"))


def crosstab(
    df: DataFrame,
    a: str,
    b: str,
    margins: bool = False,
    total: str = "All",
    weight: Column | None = None,
) -> DataFrame:
    """Counts of every (a, b) cell, empty ones as 0, optionally with margin rows."""
    cells = _filled(pair_counts(df, a, b, weight), a, b)
    if not margins:
        return cells
    texts = cells.select(F.col(a).cast("string").alias(a), F.col(b).cast("string").alias(b), "n")
    return (
        texts.cube(a, b)
        .agg(F.sum("n").alias("n"), F.grouping(a).alias("_ga"), F.grouping(b).alias("_gb"))
        .select(
            F.when(F.col("_ga") == 1, total).otherwise(F.col(a)).alias(a),
            F.when(F.col("_gb") == 1, total).otherwise(F.col(b)).alias(b),
            "n",
        )
    )


def _sums(counts: DataFrame, a: str, b: str, cells: DataFrame) -> DataFrame:
    """``cells`` with the sum of their row, of their column and of all.

    Sums are joined to the cells, a level with very many cells is spread over tasks.
    """
    whole = counts.agg(F.sum("n")).scalar()
    out = cells
    for level, other, name in ((a, b, "_row"), (b, a, "_col")):
        sums = counts.groupBy(level).agg(F.sum("n").alias(name))
        per_level = cells.groupBy(level).agg(F.count(F.lit(1)).alias("_rows"))
        out = spread_join(out, sums, [level], [other], counts=per_level)
    return out.withColumn("_all", whole)


def conditional(df: DataFrame, a: str, b: str, weight: Column | None = None) -> DataFrame:
    """Joint, conditional and marginal relative frequencies of each cell."""
    counts = pair_counts(df, a, b, weight)
    cells = _sums(counts, a, b, _filled(counts, a, b))
    return cells.select(
        a,
        b,
        "n",
        safe_ratio("n", "_all").alias("joint"),
        safe_ratio("n", "_row").alias("given_row"),
        safe_ratio("n", "_col").alias("given_col"),
        safe_ratio("_row", "_all").alias("row_marginal"),
        safe_ratio("_col", "_all").alias("col_marginal"),
    )


def expected(df: DataFrame, a: str, b: str, weight: Column | None = None) -> DataFrame:
    """Expected counts under independence and observed minus expected, empty cells included."""
    counts = pair_counts(df, a, b, weight)
    return _expected(counts, a, b, _filled(counts, a, b))


def _expected(counts: DataFrame, a: str, b: str, cells: DataFrame) -> DataFrame:
    cells = _sums(counts, a, b, cells)
    e = safe_ratio(F.col("_row").cast("double") * F.col("_col"), "_all")
    return cells.select(
        a, b, F.col("n").alias("observed"), e.alias("expected"), (F.col("n") - e).alias("residual")
    )


def chi2_independence(
    df: DataFrame, a: str, b: str, yates: bool = False, weight: Column | None = None
) -> DataFrame:
    """Chi-square test of independence: statistic, degrees of freedom, p-value.

    ``yates=True`` moves each cell towards its expectation by up to one half in
    the case of one degree of freedom.

    Only observed cells are read: an empty cell adds its expectation, and the expectations of all
    empty cells together are what those of the observed cells leave of the total. Columns may have any number
    of levels. (The correction concerns two by two cells, which are filled.)
    """
    counts = pair_counts(df, a, b, weight)
    shape = counts.agg(
        F.count_distinct(a).alias("rows"), F.count_distinct(b).alias("cols"), F.count(F.lit(1)).alias("seen")
    ).select(((F.col("rows") - 1) * (F.col("cols") - 1)).alias("dof"), (F.col("rows") * F.col("cols") > F.col("seen")).alias("gaps"))
    known = one_row(shape)
    gap, cells = F.abs(F.col("residual")), counts
    if yates and shape.first()["dof"] == 1:
        gap, cells = gap - F.least(F.lit(0.5), gap), _filled(counts, a, b)
    stat = _expected(counts, a, b, cells).agg(
        F.sum(gap * gap / F.col("expected")).alias("seen"),
        F.sum("observed").alias("n"),
        F.sum("expected").alias("covered"),
    )
    missing = F.greatest(F.col("n") - F.col("covered"), F.lit(0.0))
    if cells is not counts:
        missing = F.lit(0.0)
    return stat.withColumn("_shape", known).select(
        (F.col("seen") + F.when(F.col("_shape.gaps"), missing).otherwise(0.0)).alias("chi2"), F.col("_shape.dof").alias("dof"), "n"
    ).withColumn("p_value", chi2_sf("chi2", "dof"))


def total_probability(df: DataFrame, event: Column, given: str) -> DataFrame:
    """P(event) directly and as the sum of P(event | g) P(g), which must agree."""
    known = df.where(F.col(given).isNotNull()).groupBy(given)
    parts = staged(known.agg(F.count(F.lit(1)).alias("n"), F.sum(event.cast("long")).alias("k")))
    n = F.sum("n")
    total = parts.agg(F.sum("n")).scalar()
    return parts.agg(
        n.alias("n"),
        safe_ratio(F.sum("k"), n).alias("direct"),
        F.sum(safe_ratio("k", "n") * safe_ratio("n", total)).alias("by_parts"),
    )


def prob_given(df: DataFrame, event: Column, given: Column) -> DataFrame:
    """P(event | given) for two predicates."""
    return df.agg(
        F.count_if(given).alias("n_given"),
        F.avg(F.when(given, event.cast("double"))).alias("probability"),
    )


def set_probabilities(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """P of A, B, their intersection, union and complements, in one pass."""
    n = F.count(F.lit(1))
    both, one = F.count_if(a & b), F.count_if(a | b)
    na, nb = F.count_if(a), F.count_if(b)
    return df.agg(
        n.alias("n"),
        safe_ratio(na, n).alias("p_a"),
        safe_ratio(nb, n).alias("p_b"),
        safe_ratio(n - na, n).alias("p_not_a"),
        safe_ratio(both, n).alias("p_a_and_b"),
        safe_ratio(one, n).alias("p_a_or_b"),
        safe_ratio(na + nb - both, n).alias("p_a_or_b_by_sum"),
        safe_ratio(both, nb).alias("p_a_given_b"),
        safe_ratio(both, na).alias("p_b_given_a"),
    )
