"""Column-API helpers (for callers composing their own Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Reference a column by its exact name, even with dots or spaces in it."""
    return F.col("`" + name.replace("`", "``") + "`")
