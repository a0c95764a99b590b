"""Every registered query by name."""

from oracles import analyses_sql, distinct_sql, loads_sql, models_sql, quality_sql, star_sql  # noqa: F401
from oracles.entries import REGISTRY, Entry, portable

__all__ = ["REGISTRY", "Entry", "portable"]
