import pytest

from farelight.operators import retail
from farelight.schemas import RETAIL_SCHEMA
from farelight.sources import readers

# Retail rows with known averages.
CLEAN = [
    ("CS6043", "15-Jan-14", 98.0),
    ("CS4147", "08-Jul-13", 121.0),
    ("CS4655", "30-Mar-13", 93.0),
    ("CS3904", "20-Jul-14", 103.0),
    ("CS4102", "09-Jul-13", 96.0),
    ("CS2086", "05-Mar-13", 75.0),
    ("CS0100", "01-Feb-15", 100.0),
]

# Two bad amounts, one line without commas, one without an amount.
DIRTY = """customer_id,trans_date,tran_amount
CS1,11-Feb-13,35
CS2,15-Mar-15,39
CS3,26-Feb-13,52x
CS4,16-Nov-11,99
CS526-Mar-1481
CS6,06-Feb-12,81y
CS7,06-Feb-12,
CS8,06-Feb-12,93.5
"""


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(CLEAN, RETAIL_SCHEMA)


def test_high_value_is_strict(sales):
    assert [r.customerId for r in retail.high_value(sales).collect()] == ["CS4147", "CS3904"]
    assert retail.high_value_total(sales).first().total == 224.0
    assert retail.high_value_total(sales, 1000).first().total == 0.0


def test_averages(sales):
    found = {(r.month, r.year): r.avg_amount for r in retail.average_by_month(sales).collect()}
    assert found[("Jan", "14")] == 98.0
    assert found[("Mar", "13")] == 84.0
    assert found[("Jul", "13")] == 108.5
    assert retail.average_amount(sales).first().avg_amount == pytest.approx(98.0)
    assert retail.average_amount(sales.limit(0)).first().avg_amount is None


def test_read_good_file(spark, tmp_path):
    path = tmp_path / "good.csv"
    path.write_text("a,b,c\nCS1,11-Feb-13,35\n")
    assert [tuple(r) for r in readers.read_retail(spark, str(path)).collect()] == [("CS1", "11-Feb-13", 35.0)]


def test_bad_row_fails_the_read(spark, tmp_path):
    path = tmp_path / "dirty.csv"
    path.write_text(DIRTY)
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        readers.read_retail(spark, str(path)).collect()


def test_quarantine(spark, tmp_path):
    path = tmp_path / "dirty.csv"
    path.write_text(DIRTY)
    clean, rejected = retail.split_clean(readers.read_retail_quarantined(spark, str(path)))
    assert [tuple(r) for r in clean.collect()] == [
        ("CS1", "11-Feb-13", 35.0),
        ("CS2", "15-Mar-15", 39.0),
        ("CS4", "16-Nov-11", 99.0),
        ("CS8", "06-Feb-12", 93.5),
    ]
    assert [r.line for r in rejected.collect()] == [
        "CS3,26-Feb-13,52x", "CS526-Mar-1481", "CS6,06-Feb-12,81y", "CS7,06-Feb-12,",
    ]
    # also when the query does not look at the amounts
    assert clean.select("customerId").count() == 4
    assert rejected.count() == 4


def test_parse_lines(spark):
    lines = spark.createDataFrame([("CS1,11-Feb-13,35",)], "value string")
    assert readers.parse_retail_lines(lines).first() == ("CS1", "11-Feb-13", 35.0)
    with pytest.raises(Exception):
        bad = spark.createDataFrame([("CS1,11-Feb-13,35x",)], "value string")
        readers.parse_retail_lines(bad).collect()
