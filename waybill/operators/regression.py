"""Least squares and logistic regression.

Fits use ``pyspark.ml``: the data are read by distributed aggregation, only the
k x k normal equations and the coefficients reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.operators.frames import dummies, levels_of
from waybill.sources import from_rows

_COEFFICIENTS = "term string, coefficient double, std_error double, statistic double, p_value double"
_LOGIT = (
    f"{_COEFFICIENTS}, odds_ratio double, odds_low double, odds_high double, "
    "iterations int, converged boolean, separated boolean"
)
# A fitted probability nearer to 0 or 1 than this is taken for a separated outcome.
SEPARATED = 1e-6
_QUALITY = "n long, r2 double, adjusted_r2 double, mse double"


def line_mse(df: DataFrame, x: str, y: str, intercept: float, slope: float) -> DataFrame:
    """Mean squared error of a given line."""
    fitted = F.lit(intercept) + F.lit(slope) * F.col(x)
    return df.agg(
        F.count(F.col(x) + F.col(y)).alias("n"),
        F.avg(F.pow(F.col(y) - fitted, F.lit(2.0))).alias("mse"),
    )


def ols_simple(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    """One-regressor least squares per group, in one aggregate."""
    return df.groupBy(*by).agg(
        F.regr_count(y, x).alias("n"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_r2(y, x).alias("r2"),
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of the named columns, in one aggregate."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("column_a"),
                        F.lit(b).alias("column_b"),
                        F.col(f"c{i}").alias("correlation"),
                    )
                    for i, (a, b) in enumerate(pairs)
                ]
            )
        )
    )


@dataclass(frozen=True)
class Design:
    """What goes into a model: numeric columns, categories and products of terms."""

    xs: Sequence[str] = ()
    categories: Mapping[str, tuple[Sequence[str], str]] | None = None
    interactions: Sequence[tuple[str, str]] = ()

    def terms(self) -> list[str]:
        out = list(self.xs)
        for column, (levels, baseline) in (self.categories or {}).items():
            out += [f"{column}_{v.replace(' ', '_')}" for v in levels if v != baseline]
        return out + [f"{a}:{b}" for a, b in self.interactions]

    def expand(self, df: DataFrame) -> DataFrame:
        """Add the dummy and product columns."""
        for column, (levels, baseline) in (self.categories or {}).items():
            df = dummies(df, column, levels, baseline)
        return df.withColumns({f"{a}:{b}": F.col(a) * F.col(b) for a, b in self.interactions})


def category(df: DataFrame, column: str, baseline: str | None = None) -> tuple[list[str], str]:
    """Levels of a column and its baseline (first level unless given)."""
    levels = levels_of(df, column)
    return levels, baseline if baseline is not None else levels[0]


def _assembled(df: DataFrame, design: Design, y: str | None) -> DataFrame:
    terms = design.terms()
    data = design.expand(df)
    if y is not None:
        data = data.dropna("any", subset=[y, *terms])
    return VectorAssembler(inputCols=terms, outputCol="_features", handleInvalid="keep").transform(
        data
    )


@dataclass(frozen=True)
class OlsFit:
    design: Design
    y: str
    model: object
    coefficients: DataFrame
    quality: DataFrame

    def predict(self, df: DataFrame) -> DataFrame:
        """Every row of ``df`` with the fitted value and the residual.

        The target may be NULL; then only the residual is. A NULL regressor makes both NULL.
        """
        out = self.model.transform(_assembled(df, self.design, None))
        fitted = F.nanvl("_fitted", F.lit(None).cast("double"))
        return out.select(
            *df.columns, fitted.alias("fitted"), (F.col(self.y) - fitted).alias("residual")
        )


def ols(df: DataFrame, y: str, design: Design) -> OlsFit:
    """Least squares with intercept: coefficients, errors, t, p, R2, adjusted R2."""
    data = _assembled(df, design, y).select(F.col(y).cast("double").alias(y), "_features")
    model = LinearRegression(
        featuresCol="_features", labelCol=y, predictionCol="_fitted", solver="normal", regParam=0.0
    ).fit(data)
    s = model.summary
    names = [*design.terms(), "intercept"]
    values = [*[float(v) for v in model.coefficients], float(model.intercept)]
    rows = list(zip(names, values, s.coefficientStandardErrors, s.tValues, s.pValues))
    spark = df.sparkSession
    return OlsFit(
        design,
        y,
        model,
        from_rows(spark, [(a, *map(float, b)) for a, *b in rows], _COEFFICIENTS),
        from_rows(
            spark,
            [(int(s.numInstances), float(s.r2), float(s.r2adj), float(s.meanSquaredError))],
            _QUALITY,
        ),
    )


def compare_models(fits: Mapping[str, OlsFit]) -> DataFrame:
    """Coefficients and R2 of several models, one row per model and term."""
    out = None
    for name, fit in fits.items():
        part = fit.coefficients.select(
            F.lit(name).alias("model"), "term", "coefficient", "std_error"
        ).withColumn("r2", fit.quality.select("r2").scalar())
        out = part if out is None else out.unionByName(part)
    return out


# Fixed value: the 97.5 % point of the standard normal.
Z95 = 1.959963984540054


def _bounded_exp(x: float) -> float:
    return math.exp(x) if x < 709 else math.inf


def logit_fit(
    df: DataFrame, y: str, xs: Sequence[str], pre_aggregate: bool = True, max_iterations: int = 50
) -> DataFrame:
    """Logistic regression: coefficients, standard errors, z and p, odds ratios with 95 % bounds.

    ``converged`` tells whether the iterations ended before their limit; ``separated`` whether some
    regressors predict an outcome with certainty, in which case coefficients grow with every iteration and
    neither they nor their errors mean anything.

    With ``pre_aggregate`` rows with equal regressors become one row with their
    share of successes and their number as weight. The likelihood is the same, and
    discrete data shrink to a few rows before the iterations start.
    """
    data = df.dropna("any", subset=[y, *xs]).select(
        *[F.col(c).cast("double").alias(c) for c in (y, *xs)]
    )
    if pre_aggregate:
        data = data.groupBy(*xs).agg(
            F.avg(y).alias(y), F.count(F.lit(1)).cast("double").alias("_w")
        )
    else:
        data = data.withColumn("_w", F.lit(1.0))
    data = VectorAssembler(inputCols=list(xs), outputCol="_features").transform(data).persist()
    try:
        model = GeneralizedLinearRegression(
            family="binomial",
            link="logit",
            featuresCol="_features",
            labelCol=y,
            weightCol="_w",
            maxIter=max_iterations,
            tol=1e-10,
            linkPredictionCol="_eta",
        ).fit(data)
        s = model.summary
        furthest = model.transform(data).agg(F.max(F.abs("_eta"))).first()[0]
        separated = furthest is None or not furthest < math.log(1 / SEPARATED)
        names = [*xs, "intercept"]
        values = [*[float(v) for v in model.coefficients], float(model.intercept)]
        rows = [
            (
                *(name, float(a), float(b), float(t), float(p)),
                *(_bounded_exp(float(a) + side * Z95 * float(b)) for side in (0, -1, 1)),
                *(int(s.numIterations), s.numIterations < max_iterations and not separated, separated),
            )
            for name, a, b, t, p in zip(
                names, values, s.coefficientStandardErrors, s.tValues, s.pValues
            )
        ]
    finally:
        data.unpersist()
    return from_rows(df.sparkSession, rows, _LOGIT)


def logistic_scores(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """Every row of ``df`` with the class-1 probability of an unregularised logistic classifier.

    Equal rows are counted and weighted before the iterations. Rows without target are scored, too;
    a NULL regressor makes the probability NULL.
    """
    design = Design(xs)
    counted = df.groupBy(F.col(y).cast("double").alias(y), *xs).agg(
        F.count(F.lit(1)).cast("double").alias("_w")
    )
    model = LogisticRegression(
        featuresCol="_features",
        labelCol=y,
        probabilityCol="_probability",
        weightCol="_w",
        regParam=0.0,
        maxIter=200,
        tol=1e-10,
    ).fit(_assembled(counted, design, y))
    probability = F.nanvl(vector_to_array("_probability")[1], F.lit(None).cast("double"))
    return model.transform(_assembled(df, design, None)).select(
        *df.columns, probability.alias("probability")
    )
