"""Moments and hypothesis tests. Spark reduces the data to a few sums; p-values come last."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tillwise.functions.probability import (
    chi2_two_p,
    normal_quantile,
    student_p,
    student_two_sided,
)
from tillwise.operators.ranking import global_rank


def shape(df: DataFrame, value: str) -> DataFrame:
    """Size, population skewness and excess kurtosis, and bias-corrected skewness; one row."""
    x = F.col(value).cast("double")
    return df.agg(
        F.count(x).alias("n"), F.skewness(x).alias("skewness"), F.kurtosis(x).alias("kurtosis")
    ).withColumn(
        "skewness_corrected",
        F.col("skewness") * F.sqrt(F.col("n") * (F.col("n") - 1)) / (F.col("n") - 2),
    )


def normality(df: DataFrame, value: str) -> DataFrame:
    """D'Agostino-Pearson K2: squared z-scores of skewness and of kurtosis, added."""
    n = F.col("n").cast("double")
    moments = shape(df, value)

    # skewness, D'Agostino (1970)
    y = F.col("skewness") * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (beta2 - 1)) - 1
    z_skew = F.asinh(y / F.sqrt(2 / (w2 - 1))) / F.sqrt(0.5 * F.log(w2))

    # kurtosis, Anscombe and Glynn (1983)
    expected = 3 * (n - 1) / (n + 1)
    variance = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (F.col("kurtosis") + 3 - expected) / F.sqrt(variance)
    root_b1 = (
        6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    )
    a = 6 + 8 / root_b1 * (2 / root_b1 + F.sqrt(1 + 4 / (root_b1 * root_b1)))
    denominator = 1 + x * F.sqrt(2 / (a - 4))
    cube = (1 - 2 / a) / F.abs(denominator)
    z_kurt = (1 - 2 / (9 * a) - F.signum(denominator) * F.cbrt(cube)) / F.sqrt(2 / (9 * a))

    return moments.select("n", z_skew.alias("z_skew"), z_kurt.alias("z_kurt")).select(
        "*", (F.col("z_skew") ** 2 + F.col("z_kurt") ** 2).alias("k2")
    ).withColumn("p_value", chi2_two_p(F.col("k2")))


def qq_points(df: DataFrame, value: str, key: str) -> DataFrame:
    """Every known value, in order, against the normal quantile of its place: rank (from 1),
    theoretical, sample. Places are the medians of order statistics, as Filliben gives them; ``key``
    orders equal values."""
    rows = df.select(F.col(key).alias("_key"), F.col(value).cast("double").alias("sample")).where("sample IS NOT NULL")
    ranked = global_rank(rows, F.col("sample"), F.col("_key"), name="_rank")
    rank, n = F.col("_rank") + 1, F.col("_n")
    last = F.pow(F.lit(0.5), 1 / n)
    place = F.when(rank == n, last).when(rank == 1, 1 - last).otherwise((rank - 0.3175) / (n + 0.365))
    counted = ranked.withColumn("_n", ranked.agg(F.count("*")).scalar())
    return counted.select(rank.alias("rank"), normal_quantile(place).alias("theoretical"), "sample")


def qq_line(points: DataFrame) -> DataFrame:
    """Least-squares line through the points: n, slope, intercept, r."""
    return points.agg(
        F.count("*").alias("n"),
        F.regr_slope("sample", "theoretical").alias("slope"),
        F.regr_intercept("sample", "theoretical").alias("intercept"),
        F.corr("sample", "theoretical").alias("r"),
    )


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """r, r squared, t and two-sided p over the rows in which both values are known."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    n = F.col("n")
    return (
        df.where(a.isNotNull() & b.isNotNull())
        .agg(F.count("*").alias("n"), F.corr(a, b).alias("r"))
        .withColumn("r_squared", F.col("r") ** 2)
        .withColumn("t", F.col("r") * F.sqrt(F.try_divide(n - 2, 1 - F.col("r") ** 2)))
        .withColumn("p_value", student_p(F.col("t"), n - 2))
    )


def welch(df: DataFrame, value: str, flag: str) -> DataFrame:
    """t-test of a value between flagged and other rows, with unequal variances."""
    x = F.col(value).cast("double")

    def of(side: bool) -> list:
        mine = F.when(F.col(flag) == F.lit(side), x)
        tag = "in" if side else "out"
        return [
            F.count(mine).alias(f"n_{tag}"),
            F.avg(mine).alias(f"mean_{tag}"),
            F.var_samp(mine).alias(f"_var_{tag}"),
        ]

    a = F.col("_var_in") / F.col("n_in")
    b = F.col("_var_out") / F.col("n_out")
    degrees = F.try_divide((a + b) ** 2, a**2 / (F.col("n_in") - 1) + b**2 / (F.col("n_out") - 1))
    return (
        df.agg(*of(True), *of(False))
        .withColumn("t", F.try_divide(F.col("mean_in") - F.col("mean_out"), F.sqrt(a + b)))
        .withColumn("df", degrees)
        .withColumn("p_value", student_p(F.col("t"), F.col("df")))
        .drop("_var_in", "_var_out")
    )


def f_scores(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Univariate regression F per feature, strongest first; one pass for all features."""
    y = F.col(target).cast("double")
    correlations = df.agg(
        F.count("*").alias("_n"), *[F.corr(F.col(f).cast("double"), y).alias(f) for f in features]
    )
    return (
        correlations.unpivot(["_n"], features, "feature", "r")
        .select(
            "feature",
            "r",
            F.coalesce(
                F.try_divide(F.col("r") ** 2 * (F.col("_n") - 2), 1 - F.col("r") ** 2), F.lit(0.0)
            ).alias("f_score"),
        )
        .orderBy(F.desc("f_score"), "feature")
    )


def best_features(df: DataFrame, features: list[str], target: str, k: int = 12) -> list[str]:
    return [row.feature for row in f_scores(df, features, target).limit(k).collect()]


def gramian(df: DataFrame, columns: list[Column]) -> np.ndarray:
    """Sums of products of all column pairs, in one pass; d columns give a d x d matrix."""
    x = [c.cast("double") for c in columns]
    pairs = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    sums = df.agg(*[F.sum(x[i] * x[j]).alias(f"s{i}_{j}") for i, j in pairs]).first()
    matrix = np.zeros((len(x), len(x)))
    for (i, j), total in zip(pairs, sums):
        matrix[i, j] = matrix[j, i] = total
    return matrix


def backward_elimination(df: DataFrame, features: list[str], target: str, limit: float = 0.05) -> DataFrame:
    """Least squares with a constant, dropping the worst other column while its p exceeds
    ``limit`` and more than two columns, the constant among them, remain.

    The data are read twice: for means and deviations, and for the products of the columns so
    standardised, which do not cancel; each step works on that small matrix. Columns without
    deviation are left out. Result: term, coefficient, t, p_value and r_squared of the final model.
    """
    complete = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_{i}") for i, c in enumerate([*features, target])]).na.drop()
    names = complete.columns
    moments = complete.agg(F.count("*"), *[F.avg(c) for c in names], *[F.stddev_pop(c) for c in names]).first()
    n, means, sds = moments[0], moments[1 : len(names) + 1], moments[len(names) + 1 :]
    used = [i for i in range(len(features)) if sds[i]]
    if not used or not sds[-1]:
        raise ValueError("neither the target nor all of the features may be constant")
    matrix = gramian(complete, [(F.col(names[i]) - means[i]) / sds[i] for i in [*used, len(features)]])
    kept = list(range(len(used)))
    while True:
        inner = matrix[np.ix_(kept, kept)]
        inverse = np.linalg.pinv(inner, hermitian=True)
        beta = inverse @ matrix[kept, -1]
        rss = n - beta @ matrix[kept, -1]
        freedom = n - 1 - np.linalg.matrix_rank(inner, hermitian=True)
        variance = rss / freedom
        t = beta / np.sqrt(np.diag(inverse) * variance)
        p = [student_two_sided(float(v), float(freedom)) for v in t]
        worst = int(np.argmax(p))
        if len(kept) <= 1 or not p[worst] > limit:
            break
        kept.pop(worst)
    columns = [used[k] for k in kept]
    slopes = [float(b) * sds[-1] / sds[i] for b, i in zip(beta, columns)]
    # the constant is the mean of the target less what the means of the columns give
    const = means[-1] - sum(b * means[i] for b, i in zip(slopes, columns))
    centres = np.array([means[i] / sds[i] for i in columns])
    t_const = const / (sds[-1] * float(np.sqrt(variance * (1 / n + centres @ inverse @ centres))))
    r_squared = float(1 - rss / n)
    rows = [("const", const, t_const, student_two_sided(t_const, float(freedom)), r_squared)]
    rows += [(features[i], b, float(s), q, r_squared) for i, b, s, q in zip(columns, slopes, t, p)]
    return df.sparkSession.createDataFrame(
        rows, "term STRING, coefficient DOUBLE, t DOUBLE, p_value DOUBLE, r_squared DOUBLE"
    )
