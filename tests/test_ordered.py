"""Chunked ordered operators equal their plain window forms, hot groups included."""

import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waybill.operators import ordered
from waybill.operators.frames import group_values, impute_group_median
from waybill.operators.joins import spread_join


@pytest.fixture(scope="module")
def skewed(frame):
    """One key holds a third of the rows; values with ties, NULLs and signs."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}"
        value = None if rng.random() < 0.1 else rng.choice([-2.5, 0.0, 1.0, rng.uniform(-9, 900)])
        rows.append((i, key, rng.randrange(200), value))
    rows.append((9000, None, 1, 1.0))
    return frame("id long, k string, t int, v double", rows)


def test_running_totals(skewed, rows):
    w = W.partitionBy("k").orderBy("t", "id")
    so_far = w.rowsBetween(W.unboundedPreceding, 0)
    plain = skewed.select(
        "id", F.sum(F.lit(1)).over(so_far).alias("n"), F.sum(F.lit(1)).over(W.partitionBy("k")).alias("n_total")
    )
    for parts in (None, 1, 3, 40):
        got = ordered.running_totals(skewed, ["k"], ["t", "id"], {"n": F.lit(1)}, totals=True, parts=parts)
        assert rows(got, "id", "n", "n_total") == rows(plain)
        assert got.schema["n"].dataType == plain.schema["n"].dataType


def test_running_totals_descending_without_keys(skewed, rows):
    w = W.orderBy(F.desc("t"), F.desc("id")).rowsBetween(W.unboundedPreceding, 0)
    plain = skewed.select("id", F.sum("t").over(w).alias("s"))
    for parts in (None, 13):
        got = ordered.running_totals(skewed, [], ["t", "id"], {"s": F.col("t")}, descending=True, parts=parts)
        assert rows(got, "id", "s") == rows(plain)


def test_running_decimals_keep_their_type(frame, rows):
    df = frame("id int, v decimal(12,2)", [(i, Decimal(i) / 4) for i in range(50)])
    one, many = (ordered.running_totals(df, [], ["id"], {"s": F.col("v")}, parts=p) for p in (1, 9))
    assert one.schema == many.schema
    assert rows(one) == rows(many)


def test_history(skewed, rows):
    # NULL order values, and one order value that fills several parts
    mixed = skewed.withColumn("t", F.when(F.col("id") % 50 == 1, None).when(F.col("id") % 6 == 0, 77).otherwise(F.col("t")))
    by_row = W.partitionBy("k").orderBy("t", "id")
    whole = by_row.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    plain = mixed.select(
        "id",
        F.rank().over(W.partitionBy("k").orderBy("t")).alias("position"),
        F.lag("v").over(by_row).alias("v_prev"),
        F.first("v", ignorenulls=True).over(whole).alias("v_first"),
    )
    want = rows(plain.select("id", F.col("position").cast("long"), "v_prev", "v_first"))
    for parts in (None, 2, 37):
        got = ordered.with_history(mixed, ["k"], ["t", "id"], ["v"], parts=parts)
        assert rows(got, "id", "position", "v_prev", "v_first") == want
    assert got.groupBy().agg(F.count("position")).collect()[0][0] == 3001


def test_quantiles_match_pandas(skewed):
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    pdf = skewed.where("k IS NOT NULL").toPandas().dropna()
    want = pdf.groupby("k").v.quantile(list(probs.values())).unstack()
    want.columns = list(probs)
    for parts in (None, 25):
        got = ordered.quantiles(skewed, ["k"], "v", probs, parts).toPandas()
        pd.testing.assert_frame_equal(
            got.set_index("k").sort_index(), want.sort_index(), check_names=False
        )


def test_ranges_split_close_values(spark):
    """All values of one group lie between 1.000e9 and 1.001e9; ranges stay even."""
    df = spark.range(20_000).select(
        F.lit("a").alias("k"), (F.lit(1e9) + F.pmod(F.xxhash64("id"), F.lit(1_000_000))).alias("v")
    )
    counts = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    dealt, several = ordered.ranged(counts, ["k"], [F.col("v")], parts=16)
    sizes = [r["count"] for r in dealt.groupBy(ordered.PART).count().collect()]
    assert several and len(sizes) == 16 and max(sizes) < 3 * sum(sizes) / 16
    got = ordered.quantiles(df, ["k"], "v", {"m": 0.5, "p99": 0.99}, parts=16).collect()[0]
    assert (got["m"], got["p99"]) == tuple(df.select(F.percentile("v", F.array(F.lit(0.5), F.lit(0.99)))).collect()[0][0])


def test_quantiles_without_values(frame):
    empty = frame("k string, v double", [("a", None)])
    assert ordered.quantiles(empty, ["k"], "v", {"m": 0.5}).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("counted", [False, True])
def test_spread_join_with_hot_keys(skewed, rows, how, counted):
    small = skewed.where("k <> 'k3'").groupBy("k").agg(
        F.max("v").alias("top"), F.count(F.lit(1)).alias("n")
    )
    plain = skewed.join(small.drop("n"), "k", how)
    got = spread_join(
        skewed,
        small if counted else small.drop("n"),
        ["k"],
        ["id"],
        how,
        rows="n" if counted else None,
        hot_rows=100,
    )
    assert rows(got, "id", "top") == rows(plain, "id", "top")


def test_hot_key_is_really_spread(spark, skewed):
    small = skewed.groupBy("k").agg(F.max("v").alias("top"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = spread_join(skewed, small, ["k"], ["id"], hot_rows=100)
        placed = joined.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(p["count"] for p in placed) == 1000
    assert len(placed) > 2 and max(p["count"] for p in placed) < 700


def test_group_values(skewed, rows):
    plain = skewed.where("k IS NOT NULL").select("id", F.max("v").over(W.partitionBy("k")).alias("m"))
    got = group_values(skewed, ["k"], {"m": F.max("v")}, ["id"])
    assert rows(got.where("k IS NOT NULL"), "id", "m") == rows(plain)
    assert got.where("k IS NULL").select("m").collect()[0][0] is None


def test_impute_group_median(frame, rows):
    df = frame(
        "id int, k string, v double",
        [(1, "a", 1.0), (2, "a", 4.0), (3, "a", None), (4, "b", None), (5, None, None)],
    )
    got = impute_group_median(df, "k", "v", "w", ["id"])
    assert rows(got, "id", "w") == [(1, 1.0), (2, 4.0), (3, 2.5), (4, None), (5, None)]
