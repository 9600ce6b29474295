"""Spark SQL text helpers: quoting and the shared metric expressions.

Operators hand whole expression lists to ``selectExpr`` as text, so one JVM
call builds a projection or aggregation of any width.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Stands for the input relation in statements handed to :func:`over`.
RELATION = "\u0001relation\u0001"


def over(df: DataFrame, text: str) -> DataFrame:
    """Run a statement in which :data:`RELATION` stands for ``df``; braces of user text stay as they are."""
    body = text.replace("{", "{{").replace("}", "}}").replace(RELATION, "{df}")
    return df.sparkSession.sql(body, df=df)


def _flat(t: T.DataType) -> bool:
    plain = (T.StringType, T.BooleanType, T.DateType, T.NumericType)
    return isinstance(t, plain) and not isinstance(t, T.DecimalType)


def group_key(name: str, t: T.DataType) -> str:
    """What a column's values are grouped by: wide values by a 32-byte digest, others as they are.

    Strings, binary values and arrays of plain values go by SHA-256, so long text, markup or
    vectors never travel as shuffle keys (two different values share a digest with a
    probability below 2**-128 for any number of rows that can be stored). Arrays are digested
    as JSON, with ``-0.0`` folded into ``0.0`` as grouping does.
    """
    c = ident(name)
    if isinstance(t, (T.StringType, T.BinaryType)):
        return f"unhex(sha2(CAST({c} AS BINARY), 256))"
    if isinstance(t, T.ArrayType) and _flat(t.elementType):
        x = f"transform({c}, x -> x + 0)" if isinstance(t.elementType, (T.FloatType, T.DoubleType)) else c
        return f"unhex(sha2(CAST(to_json(named_struct('v', {x}), map('ignoreNullFields', 'false')) AS BINARY), 256))"
    return c


def is_digested(t: T.DataType) -> bool:
    return group_key("x", t) != ident("x")


def ident(name: str) -> str:
    """Quote a column name for Spark SQL (back-ticks, doubled inside)."""
    return "`" + name.replace("`", "``") + "`"


def lit(v) -> str:
    """A Spark SQL literal for a Python value (str, bool, int, float, None)."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(v) if -(2**63) <= v < 2**63 else f"CAST('{v}' AS DECIMAL(38,0))"
    if isinstance(v, float):
        if math.isnan(v):
            return "CAST('NaN' AS DOUBLE)"
        if math.isinf(v):
            return f"CAST('{'Infinity' if v > 0 else '-Infinity'}' AS DOUBLE)"
        return f"CAST({v!r} AS DOUBLE)"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def ratio(num: str, den: str) -> str:
    """``num / den`` as double; null when ``den`` is 0 (empty or all-null input).

    ``try_divide`` keeps this safe under ANSI mode, which Spark 4 enables by default.
    """
    return f"try_divide(CAST({num} AS DOUBLE), CAST({den} AS DOUBLE))"


def metric_value(x: str) -> str:
    """Cast to double and fold ``-0.0`` into ``0.0`` so equal values compare and hash alike."""
    return f"(CAST({x} AS DOUBLE) + 0.0D)"


def closed_range(x: str, lo, hi) -> str:
    """``lo <= x <= hi`` where a ``None`` bound is open."""
    parts = []
    if lo is not None:
        parts.append(f"{x} >= {lit(lo)}")
    if hi is not None:
        parts.append(f"{x} <= {lit(hi)}")
    return " AND ".join(parts) if parts else "true"


def percent(num: str, den: str) -> str:
    return f"({ratio(num, den)} * 100.0D)"
