"""Readers for the source formats of a warehouse."""
from tidemark.sources.readers import (  # noqa: F401
    after_mark,
    fan_out,
    keyed_children,
    listing,
    lookup,
    read_csv,
    read_json,
    read_jdbc,
    read_source,
    read_table,
)
