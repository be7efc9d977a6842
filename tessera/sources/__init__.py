"""Scans, sinks and fixture analogues."""

from tessera.sources.files import (
    TYPE_TOKENS,
    inventory,
    read_delimited,
    read_lines,
    read_untyped,
    read_with_catalog,
    schema_from_catalog,
    write_csv,
)

__all__ = [
    "TYPE_TOKENS",
    "inventory",
    "read_delimited",
    "read_lines",
    "read_untyped",
    "read_with_catalog",
    "schema_from_catalog",
    "write_csv",
]
