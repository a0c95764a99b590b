"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the token that stands for null inside a surrogate key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: str) -> Column:
    """md5 over the named columns as text, joined with '-', nulls as a fixed token."""
    parts = ", ".join(f"coalesce(cast({c} as string), '{NULL_TOKEN}')" for c in columns)
    return F.expr(f"md5(concat_ws('-', {parts}))")
