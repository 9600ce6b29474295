"""Expression helpers: Spark SQL text (``sql``) and Column references (``columns``)."""

from assay.functions.columns import col
from assay.functions.sql import closed_range, ident, lit, metric_value, percent, ratio

__all__ = ["closed_range", "col", "ident", "lit", "metric_value", "percent", "ratio"]
