import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelight.operators import tables
from farelight.operators.ranking import exact_quantiles, running_total, with_rank
from farelight.sources.readers import names_frame


def test_greet(spark):
    names = names_frame(spark, ["Ada", "Bo"])
    assert [r.greeting for r in tables.greet(names).collect()] == ["Hello, Ada", "Hello, Bo"]
    assert tables.greet(names, ending="!").first().greeting == "Hello, Ada!"


def test_names_and_totals(spark):
    people = spark.createDataFrame([("a", "x", True), ("b", "y", False), ("c", "x", None)], "n string, k string, f boolean")
    assert [r.name for r in tables.names_by_key(people, "n", F.col("k") == "x").collect()] == ["a", "c"]
    assert [r.name for r in tables.names_by_key(people, "n", F.col("f")).collect()] == ["a"]
    assert {r.k: r.total for r in tables.totals_by_key(people, "k").collect()} == {"x": 2, "y": 1}


def test_averages(spark):
    scores = spark.createDataFrame([("m", 1), ("m", 2), ("p", 5)], "subject string, score int")
    assert {r.subject: r.average for r in tables.averages_by_key(scores, "score", "subject").collect()} == {
        "m": 1.5, "p": 5.0,
    }


def test_email_validity(spark):
    rows = [("a", "x@y.org"), ("a", "x@y"), ("a", None), ("b", "a b@c.de")]
    df = spark.createDataFrame(rows, "k string, mail string")
    found = {r.k: (r.n_valid, r.n_invalid, r.n_missing) for r in tables.regex_validity(df, "mail", "k").collect()}
    assert found == {"a": (1, 1, 1), "b": (0, 1, 0)}


def test_first_rows_and_their_average(spark):
    dogs = spark.createDataFrame([(i, float(i), i % 2 == 0) for i in range(10)], "id int, age double, shots boolean")
    result = tables.average_of_first(dogs, "age", F.col("shots"), [F.col("id").desc()], 2)
    assert result.first().average == 7.0
    assert [r.id for r in tables.first_rows(dogs, [F.col("id").asc()]).collect()] == [0, 1, 2, 3, 4]


def test_monoid_sum(spark):
    df = spark.createDataFrame([(1, 0.5, False), (2, 0.25, True)], "i int, d double, b boolean")
    assert tuple(tables.monoid_sum(df).first()) == (3, 0.75, True)
    assert tuple(tables.monoid_sum(df.filter("false")).first()) == (0, 0.0, False)
    with pytest.raises(TypeError, match="s: string"):
        tables.monoid_sum(df.withColumn("s", F.lit("x")))


def test_average_for_repeated_ids(spark):
    scores = spark.createDataFrame([(1, 700), (2, 500), (3, 100)], "id int, score int")
    ids = spark.createDataFrame([(1,), (1,), (2,), (9,)], "id int")
    assert tuple(tables.average_for_ids(scores, ids, "id", "score", 600).first()) == (600.0, 2, 1)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, half of those on one value."""
    rng = random.Random(7)
    rows = []
    for i in range(9_000):
        group = "hot" if i % 3 == 0 else f"g{rng.randrange(40)}"
        value = 5.0 if group == "hot" and i % 2 == 0 else round(rng.expovariate(0.1), 3)
        rows.append((i, group, value))
    return spark.createDataFrame(rows, "id int, g string, v double").repartition(8), rows


def test_rank_is_a_total_order(skewed):
    df, rows = skewed
    ranked = with_rank(df, [F.col("v").asc(), F.col("id").asc()]).collect()
    expected = {row[0]: n for n, row in enumerate(sorted(rows, key=lambda r: (r[2], r[0])), 1)}
    assert {r.id: r["rank"] for r in ranked} == expected


def test_running_total_descending(skewed):
    df, rows = skewed
    total = running_total(df, [F.col("id").desc()], F.col("id"), "sum").collect()
    by_id = {r.id: r["sum"] for r in total}
    assert by_id[8_999] == 8_999
    assert by_id[0] == sum(r[0] for r in rows)
    assert by_id[8_000] == sum(range(8_000, 9_000))


@pytest.mark.parametrize("accuracy", [10_000, 100, 20])
def test_quantiles_are_exact(skewed, accuracy):
    df, rows = skewed
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    found = {(r.g, r.probability): r["quantile"] for r in exact_quantiles(df, ["g"], "v", probs, accuracy).collect()}
    groups = {}
    for _, g, v in rows:
        groups.setdefault(g, []).append(v)
    assert len(found) == len(groups) * len(probs)
    for g, values in groups.items():
        for p in probs:
            assert found[(g, p)] == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_quantiles_skip_nulls_and_keep_the_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 4.0), ("a", None), ("a", 2.0)], "g string, v double")
    found = {r.g: r["quantile"] for r in exact_quantiles(df, ["g"], "v", [0.5]).collect()}
    assert found == {None: 2.5, "a": 2.0}
    with pytest.raises(ValueError):
        exact_quantiles(df, [], "v", [0.5])


def test_median_and_maximum(skewed):
    df, rows = skewed
    found = {r.g: (r.median, r.maximum) for r in tables.median_and_maximum(df, "v", "g").collect()}
    hot = [v for _, g, v in rows if g == "hot"]
    assert found["hot"] == pytest.approx((np.median(hot), max(hot)))


def test_sorted_rows(spark):
    staff = spark.createDataFrame([("b", 5, 1), ("a", 5, 2), ("a", 1, 3)], "name string, salary int, id int")
    by_name = {r.id: r.position for r in tables.sorted_rows(staff, "name", "id").collect()}
    assert by_name == {2: 1, 3: 2, 1: 3}
    by_salary = {r.id: r.position for r in tables.sorted_rows(staff, "salary", "name", "id").collect()}
    assert by_salary == {3: 1, 2: 2, 1: 3}
