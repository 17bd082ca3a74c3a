"""Helpers for writing Spark SQL expressions."""

from __future__ import annotations


def sql_string(value: str) -> str:
    """A string literal of Spark SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_list(values) -> str:
    return ", ".join(sql_string(v) for v in values)
