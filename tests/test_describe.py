"""Quantiles and statistics of many columns against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelight.operators import describe

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


def found(df):
    return {(r["column"], r.probability): r.quantile for r in df.collect()}


def spread(spark, n=30_000):
    """Ties, a hot value that holds a third of the rows, nulls, and values far apart."""
    k = F.col("id")
    return spark.range(0, n, 1, 8).select(
        (F.hash(k) % 1_000_003).cast("long").alias("whole"),
        F.when(k % 3 == 0, F.lit(7.0)).otherwise(F.hash(k, F.lit(1)) / 1000.0).alias("hot"),
        F.when(k % 5 != 0, F.pow(F.lit(1.001), k % 9973)).alias("some"),
        F.lit(3.0).alias("same"),
        F.lit(None).cast("double").alias("a.b`c"),
    )


@pytest.mark.parametrize("accuracy", [50, 1000, 100_000])
def test_quantiles_are_those_of_all_values(spark, accuracy):
    df = spread(spark)
    names = [c for c in df.columns if c != "a.b`c"]
    values = df.select(*names).toPandas()
    result = found(describe.column_quantiles(df, df.columns, PROBABILITIES, accuracy))
    assert len(result) == len(df.columns) * len(PROBABILITIES)
    for name in names:
        column = values[name].dropna().to_numpy(float)
        for p in PROBABILITIES:
            assert result[name, p] == pytest.approx(np.quantile(column, p), rel=1e-12), (name, p)
    assert all(result["a.b`c", p] is None for p in PROBABILITIES)


def test_few_rows_nan_and_infinite_values(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1.0, nan, -inf), (2.0, 1.0, inf), (None, 0.0, 0.0), (4.0, nan, -0.0)], "a double, b double, c double")
    result = found(describe.column_quantiles(df, ["a", "b", "c"], [0.0, 0.5, 0.5, 1.0]))
    assert len(result) == 9
    assert [result["a", p] for p in (0.0, 0.5, 1.0)] == [1.0, 2.0, 4.0]
    assert result["b", 0.0] == 0.0 and math.isnan(result["b", 0.5]) and math.isnan(result["b", 1.0])
    assert [result["c", p] for p in (0.0, 0.5, 1.0)] == [-inf, 0.0, inf]


def test_describe_of_an_empty_table_and_of_none_of_its_columns(spark):
    empty = spark.createDataFrame([], "a long, b double, c string")
    rows = {r.metric: tuple(r)[1:] for r in describe.describe(empty).collect()}
    assert rows == {"a": (0,) + (None,) * 7, "b": (0,) + (None,) * 7}
    with pytest.raises(ValueError):
        describe.describe(empty.select("c"))


def test_describe(spark):
    df = spread(spark)
    row = {r.metric: r for r in describe.describe(df, ["some"], accuracy=500).collect()}["some"]
    column = df.select("some").toPandas()["some"].dropna().to_numpy(float)
    assert row.n == len(column)
    assert row["mean"] == pytest.approx(column.mean()) and row["std"] == pytest.approx(column.std(ddof=1))
    quartiles = [np.quantile(column, p) for p in (0, 0.25, 0.5, 0.75, 1)]
    assert [row["min"], row.q25, row.q50, row.q75, row["max"]] == pytest.approx(quartiles, rel=1e-12)


def test_only_the_brackets_are_put_in_order(spark, monkeypatch):
    seen = []
    real = describe.running_total

    def spy(rows, *rest):
        seen.append(rows.agg(F.sum("n")).first()[0])
        return real(rows, *rest)

    monkeypatch.setattr(describe, "running_total", spy)
    df = spark.range(0, 200_000, 1, 8).select((F.hash("id") * 1.0).alias("a"), (F.hash("id", "id") * 1.0).alias("b"))
    describe.column_quantiles(df, ["a", "b"], [0.25, 0.5, 0.75], accuracy=1000).collect()
    # Six brackets of about 4 / accuracy each, with the sketch's own error on both sides.
    assert seen[0] < 6 * 200_000 * 8 / 1000
