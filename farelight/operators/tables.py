"""General table operators: selection, counts, means, order and sums by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from farelight.operators.ranking import exact_quantiles, match, with_rank


def greet(names: DataFrame, name: str = "name", ending: str = "") -> DataFrame:
    """``Hello, <name>`` with an optional ending such as ``!``."""
    return names.select(F.concat(F.lit("Hello, "), F.col(name), F.lit(ending)).alias("greeting"))


def names_by_key(df: DataFrame, name: str, condition: Column) -> DataFrame:
    """Names of the rows that meet a condition on a key or a flag."""
    return df.filter(condition).select(F.col(name).alias("name"))


def totals_by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Row count for every key at once."""
    return df.groupBy(*keys).agg(F.count("*").alias("total"))


def averages_by_key(df: DataFrame, value: str, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias("average"))


def median_and_maximum(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """Exact median (midpoint for an even count) and maximum per key.

    The maximum is a plain aggregate and keeps the type of ``value``. NaN is the largest
    value; a key without values has nulls.
    """
    medians = exact_quantiles(df, keys, value, [0.5]).drop("probability").withColumnRenamed("quantile", "median")
    maxima = df.groupBy(*keys).agg(F.max(value).alias("maximum"))
    return match(medians, maxima, keys).select(*keys, "median", "maximum")


# Fixed value: the shape of an e-mail address.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def regex_validity(df: DataFrame, column: str, *keys: str, pattern: str = EMAIL) -> DataFrame:
    """Valid, invalid and missing values of a text column per key."""
    value = F.col(column)
    return df.groupBy(*keys).agg(
        F.count_if(value.rlike(pattern)).alias("n_valid"),
        F.count_if(~value.rlike(pattern)).alias("n_invalid"),
        F.count_if(value.isNull()).alias("n_missing"),
    )


def average_of_first(df: DataFrame, value: str, flag: Column, order: Sequence[Column], n: int) -> DataFrame:
    """Mean over the first ``n`` flagged rows in the given order."""
    return df.filter(flag).orderBy(*order).limit(n).agg(F.avg(value).alias("average"))


def first_rows(df: DataFrame, order: Sequence[Column], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def sorted_rows(df: DataFrame, *order: str) -> DataFrame:
    """Rows with their position in a total order; end ``order`` with a unique column."""
    return with_rank(df, [F.col(c).asc() for c in order], "position")


def monoid_sum(df: DataFrame) -> DataFrame:
    """Add up every column by its type: numbers are summed, booleans are or-ed."""
    sums = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.BooleanType):
            sums.append(F.coalesce(F.bool_or(field.name), F.lit(False)).alias(field.name))
        elif isinstance(field.dataType, T.NumericType):
            sums.append(F.coalesce(F.sum(field.name), F.lit(0)).alias(field.name))
        else:
            raise TypeError(f"No sum for {field.name}: {field.dataType.simpleString()}")
    return df.agg(*sums)


def average_for_ids(
    scores: DataFrame, ids: DataFrame, key: str, score: str, threshold: float
) -> DataFrame:
    """Mean score, count and number at or above the threshold, over a set of ids.

    Both sides are combined per id before they are shuffled, so an id with very many
    scores or mentions is one row in the join, which then needs no shuffle of its own.
    """
    per_id = scores.groupBy(key).agg(
        F.sum(score).alias("_sum"),
        F.count(score).alias("_n"),
        F.count_if(F.col(score) >= F.lit(threshold)).alias("_passed"),
    )
    wanted = ids.select(key).distinct()
    return per_id.join(wanted, key, "left_semi").agg(
        F.try_divide(F.sum("_sum"), F.sum("_n")).alias("average"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_scores"),
        F.coalesce(F.sum("_passed"), F.lit(0)).alias("n_passed"),
    )
