"""Retail transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from farelight.schemas import RETAIL_SCHEMA

AMOUNT, DATE = "transactionAmount", "transactionDate"
HIGH_VALUE = 100.0


def high_value(transactions: DataFrame, threshold: float = HIGH_VALUE) -> DataFrame:
    """Transactions above, not at, the threshold."""
    return transactions.filter(F.col(AMOUNT) > F.lit(threshold))


def high_value_total(transactions: DataFrame, threshold: float = HIGH_VALUE) -> DataFrame:
    """Sum of the amounts above the threshold."""
    total = F.coalesce(F.sum(AMOUNT), F.lit(0.0))
    return high_value(transactions, threshold).agg(total.alias("total"))


def month_and_year(date: Column) -> tuple[Column, Column]:
    """Second and third part of a ``day-month-year`` text, both kept as text."""
    parts = F.split(date, "-")
    return parts.getItem(1), parts.getItem(2)


def average_amount(transactions: DataFrame) -> DataFrame:
    return transactions.agg(F.avg(AMOUNT).alias("avg_amount"))


def average_by_month(transactions: DataFrame) -> DataFrame:
    month, year = month_and_year(F.col(DATE))
    return transactions.groupBy(month.alias("month"), year.alias("year")).agg(
        F.avg(AMOUNT).alias("avg_amount")
    )


def split_clean(quarantined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean transactions, and the lines of the malformed rows, of a quarantining read."""
    bad = F.col("rejected_line")
    clean = quarantined.filter(bad.isNull()).select(*RETAIL_SCHEMA.names)
    return clean, quarantined.filter(bad.isNotNull()).select(bad.alias("line"))
