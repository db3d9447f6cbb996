"""Scans, layout and sinks."""

from cauce.sources.delimited import (
    ORD,
    dedupe_names,
    locate_header,
    order_column,
    preview_lines,
    read_csv_default,
    read_delimited,
    read_lines,
    read_sniffed,
    read_with_preamble,
    sniff_separator,
    split_header,
)
from cauce.sources.layout import SOURCES, Layout
from cauce.sources.sinks import guard_overwrite, write_csv, write_parquet

__all__ = [
    "ORD",
    "SOURCES",
    "Layout",
    "dedupe_names",
    "guard_overwrite",
    "locate_header",
    "order_column",
    "preview_lines",
    "read_csv_default",
    "read_delimited",
    "read_lines",
    "read_sniffed",
    "read_with_preamble",
    "sniff_separator",
    "split_header",
    "write_csv",
    "write_parquet",
]
