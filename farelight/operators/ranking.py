"""Total order and exact quantiles without bringing a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from farelight.session import written


def running_total(df: DataFrame, order: Sequence[Column], amount: Column, name: str) -> DataFrame:
    """Add the sum of ``amount`` over this row and all rows before it in ``order``.

    ``order`` has to be a total order (end it with a unique column). Rows are range
    partitioned on it and written once, so that each range is summed on its own and
    then shifted by the sum of the ranges before it. Only the per-range sums, one row
    per shuffle partition, meet in one place.
    """
    placed = written(
        df.repartitionByRange(*order)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_amount", amount.cast("long")),
        "ranges",
    )
    per_range = placed.groupBy("_range").agg(F.sum("_amount").alias("_total"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = per_range.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumn("_inside", F.sum("_amount").over(inside))
        # One row per shuffle partition: the bound on what is broadcast here.
        .join(F.broadcast(shifts), "_range")
        .withColumn(name, F.col("_inside") + F.col("_shift"))
        .drop("_range", "_amount", "_total", "_inside", "_shift")
    )


def with_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Number all rows from 1 in ``order``, which has to be a total order."""
    return running_total(df, order, F.lit(1), name)


def exact_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    accuracy: int = 10_000,
) -> DataFrame:
    """Exact quantiles with linear interpolation: ``by..., probability, quantile``.

    A sketch per group gives its size, and brackets each quantile between two values whose
    ranks are off by at most ``1 / accuracy`` of the group. Groups of at most
    ``2 * accuracy`` values are then computed directly. For larger ones, one more scan
    counts what lies below the bracket and keeps the distinct values inside it, a small
    part of the group; those are put in order by :func:`running_total`, across tasks, and
    the wanted ranks are read off. The counts are exact, so the result is too, and a
    bracket that did not hold its rank would fail the query.

    Nulls are left out, NaN is the largest value, and a group without values has null
    quantiles.
    """
    if not by:
        raise ValueError("exact_quantiles needs at least one grouping column")
    probabilities = list(dict.fromkeys(float(p) for p in probabilities))
    rows = df.select(*by, F.col(value).cast("double").alias("_value"))
    # Written, so that the joins below know the true size of this side.
    sketch = written(_sketch(rows, by, probabilities, accuracy), "sketch")
    large = F.col("_n") > 2 * accuracy
    direct = _direct_quantiles(match(rows, sketch.filter(~large), by), by, probabilities)
    if sketch.filter(large).isEmpty():
        return direct
    return direct.unionByName(_bracketed_quantiles(match(rows, sketch.filter(large), by), by))


def _sketch(rows: DataFrame, by: Sequence[str], probabilities: list[float], accuracy: int) -> DataFrame:
    slack = 2.0 / accuracy
    lows = [max(0.0, p - slack) for p in probabilities]
    highs = [min(1.0, p + slack) for p in probabilities]
    # The sketch cannot hold NaN in order, so it counts as infinite there.
    nan, infinite = F.lit(float("nan")), F.lit(float("inf"))
    edges = F.percentile_approx(F.when(F.isnan("_value"), infinite).otherwise(F.col("_value")), lows + highs, accuracy).alias("_edges")
    sketch = rows.groupBy(*by).agg(F.count("_value").alias("_n"), F.min("_value").alias("_min"), F.max("_value").alias("_max"), edges)
    brackets = []
    for i, p in enumerate(probabilities):
        # Ranks are counted from 0; the quantile lies between the two around (n - 1) * p.
        at = (F.col("_n") - 1) * F.lit(p)
        low = F.col("_min") if lows[i] == 0.0 else F.col("_edges")[i]
        edge = F.col("_edges")[i + len(probabilities)]
        high = F.col("_max") if highs[i] == 1.0 else F.when(edge == infinite, nan).otherwise(edge)
        brackets.append(
            F.struct(
                F.lit(p).alias("probability"),
                low.alias("_low"),
                high.alias("_high"),
                F.floor(at).cast("long").alias("_rank"),
                (at - F.floor(at)).alias("_part"),
            )
        )
    return sketch.select(*by, "_n", F.array(*brackets).alias("_brackets"))


def match(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Inner join by columns in which nulls are equal, keeping one copy of them."""
    renamed = left.withColumnsRenamed({c: f"_left_{c}" for c in by})
    same = [F.col(f"_left_{c}").eqNullSafe(F.col(c)) for c in by]
    return renamed.join(right, same, "inner").drop(*[f"_left_{c}" for c in by])


def _direct_quantiles(matched: DataFrame, by: Sequence[str], probabilities: list[float]) -> DataFrame:
    """For groups known to be small: their values fit in one aggregation buffer."""
    levels = F.array(*[F.lit(p) for p in probabilities])
    found = matched.groupBy(*by).agg(F.percentile("_value", levels).alias("_found"))
    none = F.array(*[F.lit(None).cast("double") for _ in probabilities])
    pairs = F.arrays_zip(levels.alias("probability"), F.coalesce("_found", none).alias("quantile"))
    return found.select(*by, F.inline(pairs).alias("probability", "quantile"))


def _bracketed_quantiles(matched: DataFrame, by: Sequence[str]) -> DataFrame:
    """For groups of any size."""
    counted = (
        matched.select(*by, "_value", F.explode("_brackets").alias("_b"))
        .select(*by, "_b.*", "_value")
        .filter(F.col("_value") <= F.col("_high"))
        # All values below a bracket fall on one key, null, before the shuffle.
        .withColumn("_value", F.when(F.col("_value") >= F.col("_low"), F.col("_value")))
        .groupBy(*by, "probability", "_rank", "_part", "_value")
        .agg(F.count("*").alias("_count"))
    )
    group = [*by, "probability"]
    order = [*[F.col(c).asc_nulls_first() for c in group], F.col("_value").asc_nulls_first()]
    summed = running_total(counted, order, F.col("_count"), "_upto")
    starts = summed.groupBy(*group).agg(F.min(F.col("_upto") - F.col("_count")).alias("_start"))
    ranked = match(summed, starts, group)

    reached = F.col("_upto") - F.col("_start")
    rank = F.col("_rank")
    # The null value stands for all that lies below the bracket.
    too_high = F.max(F.col("_value").isNull() & (reached > rank))
    too_low = F.max(reached) <= F.max(rank)

    def value_at(position: Column) -> Column:
        return F.min(F.when(reached > position, F.col("_value")))

    low, high, part = F.col("_at"), F.coalesce("_next", "_at"), F.col("_part")
    # Infinite values have no difference, so both ends are weighted, and only if they differ.
    quantile = F.when((part == 0) | (low == high), low).otherwise((1 - part) * low + part * high)
    missed = F.raise_error(F.lit("quantile bracket missed its rank")).cast("double")
    return (
        ranked.groupBy(*group)
        .agg(
            value_at(rank).alias("_at"),
            value_at(rank + 1).alias("_next"),
            F.max("_part").alias("_part"),
            (too_high | too_low).alias("_missed"),
        )
        .select(*group, F.when(F.col("_missed"), missed).otherwise(quantile).alias("quantile"))
    )
