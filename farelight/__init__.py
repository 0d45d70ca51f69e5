"""farelight: trip quality gates, zone enrichment, weekly KPIs and small table
operators, written as Spark DataFrame expressions."""

__version__ = "0.1.0"
