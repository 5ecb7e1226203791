"""Counts and scores shared by the predictive operators.

With smoothing 1 the score of a class with ``size`` rows for a query of ``h`` features is

    ln(size + 1) - h * ln(size + 2) + sum of ln(n + 1) over the features seen with it

up to a constant that the softmax removes (``n``: rows of the class with the feature).  A
feature never seen with the class adds ln(1) = 0, so only seen pairs ever need joining.
Every class of a query that shares no feature with it has the *baseline* score.

A token of a Text field is a yes/no class of its own; its score is the log-odds

    ln((size+1)/(N-size+1)) + h*ln((N-size+2)/(size+2)) - sum over features of ln(n_f+1)
        + sum over seen of ln((n+1)*(n_f+1)/(n_f-n+1))

In both cases the baseline depends on the class only through ``size``: it falls with
``size`` when ``h >= 2`` and rises otherwise, and seen pairs add positive amounts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foretell.operators.index import with_index

BIN = 256.0  # width of the exponent bins of log_sum_exp; e^256 is far from overflow
SCORE_DIGITS = 9  # scores closer than this are ties


def unnest(column: str) -> Column:
    """One row per element of an array column; null for an empty one.

    For a plain ``explode`` of a column Spark infers a filter on its size and pushes it below
    the projection that made the column, which would tokenise every text twice.
    """
    return F.explode_outer(column)


def baseline(size: Column, h: Column, n_rows: Column | None = None) -> Column:
    """Score of a class that shares no feature (``n_rows`` given: log-odds of a token)."""
    if n_rows is None:
        return F.log(size + 1.0) - h * F.log(size + 2.0)
    rest = n_rows - size
    return F.log((size + 1.0) / (rest + 1.0)) + h * F.log((rest + 2.0) / (size + 2.0))


def gain(n: Column, n_f: Column | None = None) -> Column:
    """What one seen pair adds (``n_f`` given: to the log-odds of a token)."""
    if n_f is None:
        return F.log(n + 1.0)
    return F.log((n + 1.0) * (n_f + 1.0) / (n_f - n + 1.0))


def best_first(score: str, size: str, h: Column, feature: str = "feature") -> list:
    """Ascending keys of hits: score, then the better baseline by class size, then the name."""
    s = F.col(size)
    return [-F.round(F.col(score), SCORE_DIGITS), F.when(h >= 2, s).otherwise(-s), F.col(feature)]


def take_best(df: DataFrame, order: list, limit: int | None) -> DataFrame:
    """The ``limit`` rows that come first by the ascending keys, with their rank.

    A partial top-n, then a window over those few; without a limit the rank is the position
    in a range-partitioned order.
    """
    if limit is None:
        return with_index(df, order, "_at").withColumn("rank", (F.col("_at") + 1).cast("int")).drop("_at")
    return df.orderBy(*order).limit(limit).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def log_sum_exp(df: DataFrame, keys: list, score: Column, weight: Column | None = None) -> DataFrame:
    """``ln(sum of weight * exp(score))`` per group as column ``lse``.

    The sum is split by exponent bins, so it combines map-side, needs no maximum
    beforehand and leaves a handful of numbers per group for the second step.
    """
    e = F.floor(score / BIN)
    value = F.exp(score - e * BIN) * (weight if weight is not None else F.lit(1.0))
    by_bin = df.select(*keys, e.alias("_e"), value.alias("_v")).groupBy(*keys, "_e").agg(F.sum("_v").alias("_v"))
    terms = by_bin.where("_v > 0").select(*keys, (F.col("_e") * BIN + F.log("_v")).alias("_t"))
    grouped = terms.groupBy(*keys).agg(F.collect_list("_t").alias("_t"))
    return grouped.select(*keys, lse_of("_t").alias("lse"))


def lse_of(array: Column | str) -> Column:
    """ln of the sum of the exponentials of an array."""
    array = F.col(array) if isinstance(array, str) else array
    top = F.array_max(array)
    return top + F.log(F.reduce(array, F.lit(0.0), lambda acc, t: acc + F.exp(t - top)))


def feature_counts(df: DataFrame, classes: Column, features: Column) -> DataFrame:
    """``(feature, class, n)``: rows of each class with each feature, combined map-side."""
    return (
        df.select(classes.alias("_c"), F.explode(features).alias("feature"))
        .select("feature", unnest("_c").alias("class"))
        .where(F.col("class").isNotNull())
        .groupBy("feature", "class")
        .agg(F.count("*").alias("n"))
    )


def class_counts(df: DataFrame, classes: Column) -> DataFrame:
    """``(class, size)``."""
    return (
        df.select(F.explode(classes).alias("class"))
        .where(F.col("class").isNotNull())
        .groupBy("class")
        .agg(F.count("*").alias("size"))
    )
