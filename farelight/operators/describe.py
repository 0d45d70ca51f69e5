"""Exact quantiles and summary statistics of many columns at once, at any size."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from farelight.operators.ranking import running_total
from farelight.session import written

QUARTILES = (0.25, 0.5, 0.75)


@dataclass(frozen=True)
class _Bracket:
    """Two values between which a quantile lies, and its rank, counted from 0."""

    column: int
    probability: float
    low: float
    high: float
    rank: int
    part: float
    n: int
    from_minimum: bool

    @property
    def value(self) -> Column:
        return F.col(f"v{self.column}")

    @property
    def inside(self) -> Column:
        return (self.value >= F.lit(self.low)) & (self.value <= F.lit(self.high))


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int = 10_000
) -> DataFrame:
    """Exact quantiles with linear interpolation: ``column, probability, quantile``.

    One pass sketches all columns and brackets each quantile. A second one counts what lies
    below the brackets, and a third keeps the distinct values inside them, about
    ``4 / accuracy`` of the rows, which are put in order across tasks. Nothing else is
    shuffled, and the driver gets a few numbers for each column and probability. The result
    is exact; a bracket that did not hold its ranks would fail the query. Columns with at most
    ``2 * accuracy`` values need no brackets: one aggregate holds all of those.

    Nulls are left out, NaN is the largest value, and a column without values has null
    quantiles.
    """
    probabilities = list(dict.fromkeys(float(p) for p in probabilities))
    rows, sketch = _sketched(df, columns, probabilities, accuracy)
    return _quantiles(rows, sketch, columns, probabilities, accuracy)


def describe(df: DataFrame, columns: Sequence[str] | None = None, accuracy: int = 10_000) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column, in rows.

    ``columns`` are the long and double ones unless given. A column without values has the
    count 0 and nulls. See :func:`column_quantiles` for how it is computed.
    """
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.LongType, T.DoubleType))]
    rows, sketch = _sketched(df, columns, QUARTILES, accuracy)
    names = ("n", "mean", "std", "min", "max")
    per_column = [
        F.struct(F.lit(name).alias("metric"), *[F.col(f"c{i}.{s}").alias(s) for s in names])
        for i, name in enumerate(columns)
    ]
    stats = sketch.select(F.inline(F.array(*per_column)))
    found = _quantiles(rows, sketch, columns, QUARTILES, accuracy)
    quartiles = found.groupBy(F.col("column").alias("metric")).agg(
        *[F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(f"q{round(100 * p)}") for p in QUARTILES]
    )
    # One row per column on both sides.
    joined = stats.join(F.broadcast(quartiles), "metric")
    return joined.select("metric", "n", "mean", "std", "min", "q25", "q50", "q75", "max")


def _sketched(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int
) -> tuple[DataFrame, DataFrame]:
    """The columns as doubles ``v0, v1, ...``, and one row with statistics ``c0, c1, ...`` of each."""
    if not columns or not probabilities:
        raise ValueError("needs at least one column and one probability")
    quoted = ["`" + c.replace("`", "``") + "`" for c in columns]
    rows = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(quoted)])
    slack = 2.0 / accuracy
    edges = [max(0.0, p - slack) for p in probabilities] + [min(1.0, p + slack) for p in probabilities]

    def statistics(value: Column) -> Column:
        # The sketch cannot hold NaN in order, so it counts as infinite there.
        ordered = F.when(F.isnan(value), F.lit(float("inf"))).otherwise(value)
        return F.struct(
            F.count(value).alias("n"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.percentile_approx(ordered, edges, accuracy).alias("edges"),
        )

    one = rows.agg(*[statistics(F.col(f"v{i}")).alias(f"c{i}") for i in range(len(columns))])
    # Written, because it is one pass over everything and is looked at twice.
    return rows, written(one, "sketch")


def _brackets(found: Row, probabilities: Sequence[float], accuracy: int) -> list[_Bracket]:
    """For the columns with so many values that the slack is at least four ranks."""
    slack = 2.0 / accuracy
    brackets = []
    for i, stats in enumerate(found):
        for k, p in enumerate(probabilities if stats.n > 2 * accuracy else []):
            from_minimum = p <= slack
            high = stats.max if p >= 1 - slack else stats.edges[k + len(probabilities)]
            rank = int((stats.n - 1) * p)
            brackets.append(
                _Bracket(
                    column=i,
                    probability=p,
                    low=stats.min if from_minimum else stats.edges[k],
                    high=float("nan") if high == float("inf") else high,
                    rank=rank,
                    part=(stats.n - 1) * p - rank,
                    n=stats.n,
                    from_minimum=from_minimum,
                )
            )
    return brackets


def _direct(rows: DataFrame, few: Sequence[int], probabilities: Sequence[float]) -> DataFrame:
    """For columns whose values fit in one aggregation buffer."""
    levels = F.array(*[F.lit(p) for p in probabilities])
    one = rows.agg(*[F.percentile(f"v{i}", levels).alias(f"q{i}") for i in few])
    entries = [
        F.struct(F.lit(i).alias("_i"), F.lit(p).alias("probability"), F.col(f"q{i}")[k].alias("quantile"))
        for i in few
        for k, p in enumerate(probabilities)
    ]
    return one.select(F.inline(F.array(*entries)))


def _below(rows: DataFrame, brackets: Sequence[_Bracket]) -> list[int]:
    """How many values lie below each bracket; one pass, and none if all begin at the minimum."""
    asked = [k for k, b in enumerate(brackets) if not b.from_minimum]
    counts = [0] * len(brackets)
    if asked:
        # One row, with a number for each bracket.
        found = rows.agg(*[F.count_if(brackets[k].value < F.lit(brackets[k].low)) for k in asked]).first()
        for k, n in zip(asked, found):
            counts[k] = n
    return counts


def _quantiles(
    rows: DataFrame, sketch: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int
) -> DataFrame:
    wanted = sketch.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("_i"), F.lit(c).alias("column"), F.lit(p).alias("probability"))
                    for i, c in enumerate(columns)
                    for p in probabilities
                ]
            )
        )
    )
    # One row, with a few numbers for each column.
    stats = sketch.first()
    few = [i for i, s in enumerate(stats) if 0 < s.n <= 2 * accuracy]
    brackets = _brackets(stats, probabilities, accuracy)
    parts = [_direct(rows, few, probabilities)] if few else []
    parts += [_bracketed(rows, brackets)] if brackets else []
    if not parts:
        return wanted.select("column", "probability", F.lit(None).cast("double").alias("quantile"))
    # One row per column and probability is broadcast.
    found = F.broadcast(reduce(DataFrame.unionByName, parts))
    return wanted.join(found, ["_i", "probability"], "left").select("column", "probability", "quantile")


def _bracketed(rows: DataFrame, brackets: Sequence[_Bracket]) -> DataFrame:
    """For columns of any size: ``_i, probability, quantile``."""
    below = _below(rows, brackets)

    entries = [
        F.when(b.inside, F.struct(F.lit(k).alias("bracket"), b.value.alias("value"))) for k, b in enumerate(brackets)
    ]
    # Most rows are in no bracket, and go before an array is made of them.
    held = rows.filter(reduce(Column.__or__, [b.inside for b in brackets])).select(F.inline(F.array(*entries)))
    counted = held.filter("bracket is not null").groupBy("bracket", "value").agg(F.count("*").alias("n"))
    summed = running_total(counted, [F.col("bracket"), F.col("value")], F.col("n"), "upto")
    starts = summed.groupBy("bracket").agg(F.min(F.col("upto") - F.col("n")).alias("start"))

    def of_bracket(values: Sequence) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("bracket") + 1)

    fixed = [
        of_bracket(values).alias(name)
        for name, values in {
            "_below": [int(n) for n in below],
            "_rank": [b.rank for b in brackets],
            "_part": [b.part for b in brackets],
            "_n": [b.n for b in brackets],
            "_i": [b.column for b in brackets],
            "probability": [b.probability for b in brackets],
        }.items()
    ]
    # One row per bracket is broadcast.
    placed = summed.join(F.broadcast(starts), "bracket").select(
        "bracket", "value", (F.col("upto") - F.col("start")).cast("long").alias("upto"), *fixed
    )
    reached, rank = F.col("upto") + F.col("_below"), F.col("_rank")
    ends = placed.groupBy("bracket", "_below", "_rank", "_part", "_n", "_i", "probability").agg(
        F.min(F.when(reached > rank, F.col("value"))).alias("_at"),
        F.min(F.when(reached > rank + 1, F.col("value"))).alias("_next"),
    )
    low, high, part = F.col("_at"), F.col("_next"), F.col("_part")
    missed = (F.col("_below") > rank) | low.isNull() | (high.isNull() & (rank + 1 < F.col("_n")))
    # Infinite values have no difference, so both ends are weighted, and only if they differ.
    quantile = F.when((part == 0) | (low == high), low).otherwise((1 - part) * low + part * high)
    error = F.raise_error(F.lit("quantile bracket missed its rank")).cast("double")
    return ends.select("_i", "probability", F.when(missed, error).otherwise(quantile).alias("quantile"))
