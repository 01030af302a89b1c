"""Rates within strata against rates overall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.functions import safe_ratio
from waybill.operators.staging import staged


def stratum_counts(df: DataFrame, group: str, stratum: str, num: Column, den: Column) -> DataFrame:
    """Numerator and denominator of each group and stratum, kept for the comparisons below."""
    return staged(
        df.groupBy(group, stratum).agg(F.sum(num).alias("num"), F.sum(den).alias("den"))
    )


def standardised_rate(counts: DataFrame, group: str, stratum: str) -> DataFrame:
    """Rate and share of each stratum of a group, and the rate the group adds up to."""
    w = Window.partitionBy(group)
    parts = counts.select(
        group,
        stratum,
        "num",
        "den",
        safe_ratio("num", "den").alias("rate"),
        safe_ratio("den", F.sum("den").over(w)).alias("share"),
    )
    return parts.withColumn("total_rate", F.sum(F.col("rate") * F.col("share")).over(w))


def reversals(counts: DataFrame, group: str, stratum: str, baseline: str) -> DataFrame:
    """Groups whose overall difference to ``baseline`` has the opposite sign in every stratum.

    Strata missing in either group are not compared. ``reversed`` is NULL when
    nothing can be compared.
    """
    base = counts.where(F.col(group) == baseline).select(
        stratum, F.col("num").alias("_bn"), F.col("den").alias("_bd")
    )
    base_total = base.agg(safe_ratio(F.sum("_bn"), F.sum("_bd"))).scalar()
    gap = safe_ratio("num", "den") - safe_ratio("_bn", "_bd")
    others = counts.where(F.col(group) != baseline)
    overall = others.groupBy(group).agg(
        (safe_ratio(F.sum("num"), F.sum("den")) - base_total).alias("overall_difference")
    )
    strata = (
        others.join(base, stratum)
        .withColumn("_sign", F.signum(gap))
        .where("_sign IS NOT NULL")
        .groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("strata"),
            F.min("_sign").alias("_low"),
            F.max("_sign").alias("_high"),
        )
    )
    sign = F.signum("overall_difference")
    return overall.join(strata, group, "left").select(
        group,
        "overall_difference",
        F.coalesce("strata", F.lit(0)).alias("strata"),
        (
            (F.col("_low") == F.col("_high")) & (sign * F.col("_low") == -1)
        ).alias("reversed"),
    )


def reweighted_rate(counts: DataFrame, group: str, stratum: str, standard: str) -> DataFrame:
    """Each group's own rates averaged over the stratum mix of group ``standard``.

    Only strata of the standard with a rate in the group can be weighted;
    ``covered`` is the share of the standard they make up.
    """
    mix = counts.where(F.col(group) == standard).select(stratum, F.col("den").alias("_w"))
    whole = mix.agg(F.sum("_w")).scalar()
    rate = safe_ratio("num", "den")
    return (
        counts.join(mix, stratum)
        .where(rate.isNotNull())
        .groupBy(group)
        .agg(
            safe_ratio(F.sum("num"), F.sum("den")).alias("own_rate"),
            safe_ratio(F.sum(rate * F.col("_w")), F.sum("_w")).alias("reweighted_rate"),
            safe_ratio(F.sum("_w"), F.max(whole)).alias("covered"),
        )
    )
