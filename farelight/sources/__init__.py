from farelight.sources.layouts import read_layouts, rescued_report
from farelight.sources.readers import (
    read_kpis,
    read_lines,
    read_retail,
    read_retail_quarantined,
    read_trips,
    read_zones,
    names_frame,
)
from farelight.sources.writers import write_csv, write_kpis, write_parquet, write_word_counts

__all__ = [
    "names_frame",
    "read_kpis",
    "read_layouts",
    "read_lines",
    "read_retail",
    "read_retail_quarantined",
    "read_trips",
    "read_zones",
    "rescued_report",
    "write_csv",
    "write_kpis",
    "write_parquet",
    "write_word_counts",
]
