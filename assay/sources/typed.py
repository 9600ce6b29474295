"""CSV with inferred types in one parse of the text.

Spark's own inference reads a CSV once for the types and again for every use. Here the cells are staged
as text, once, in columnar form; one aggregation over that copy counts for each column how many cells fit
each type, and the typed table is a cast of the copy. So however often the table is used, its text is parsed
a single time, and a wrong cell does not turn a column of numbers into text without a trace: with
``max_bad_share`` a column takes the narrowest type that all but that share of its cells fit (a wider
number type, if more cells are such numbers), the others become null in the table and are kept, as they were, in ``bad_cells``.

Types, narrowest first: int, bigint, double, date, timestamp, boolean, string (dates and timestamps in ISO
form). An empty cell and the ``null_tokens`` are null and fit every type; a column without any value is a
string. Lines with more or fewer fields than the header are counted, kept as far as they can be read, and
listed with their text in ``malformed``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.functions import col
from assay.functions.sql import ident, lit
from assay.session import stage_as_parquet
from assay.sources.tables import MALFORMED

# How a cell of each type is written.
FORMS = {
    "int": r"^\\s*[+-]?\\d+\\s*$",
    "bigint": r"^\\s*[+-]?\\d+\\s*$",
    "double": None,
    "date": r"^\\d{4}-\\d{2}-\\d{2}$",
    "timestamp": r"^\\d{4}-\\d{2}-\\d{2}[ T]\\d{2}:\\d{2}(:\\d{2}(\\.\\d{1,9})?)?(Z|[+-]\\d{2}:?\\d{2})?$",
    "boolean": "^([Tt][Rr][Uu][Ee]|[Ff][Aa][Ll][Ss][Ee])$",
}


def as_type(column: str, kind: str) -> str:
    """SQL of a text cell as a type; null where it does not fit."""
    c = ident(column)
    if kind == "string":
        return c
    cast = f"try_cast({c} AS {kind})"
    return cast if FORMS[kind] is None else f"CASE WHEN {c} RLIKE '{FORMS[kind]}' THEN {cast} END"


@dataclass(frozen=True)
class TypedTable:
    table: DataFrame
    bad_cells: DataFrame  # column, cell, n
    malformed: DataFrame  # line
    types: dict[str, str]
    bad: dict[str, int]  # cells that do not fit, by column
    malformed_lines: int


def choose_types(staged: DataFrame, columns: Sequence[str], max_bad_share: float = 0.0) -> tuple[dict[str, str], dict[str, int], int]:
    """(type of each column, cells that do not fit it, malformed lines): one aggregation, one row."""
    aggs = [F.expr(f"count({ident(MALFORMED)})").alias("_malformed")] if MALFORMED in staged.columns else [F.lit(0).alias("_malformed")]
    for i, c in enumerate(columns):
        aggs.append(F.expr(f"count({ident(c)})").alias(f"n{i}"))
        aggs += [F.expr(f"count({as_type(c, k)})").alias(f"n{i}_{k}") for k in FORMS]
    row = staged.agg(*aggs).first()
    types, bad = {}, {}
    for i, c in enumerate(columns):
        n = row[f"n{i}"]
        fits = [k for k in FORMS if n and n - row[f"n{i}_{k}"] <= max_bad_share * n]
        types[c] = fits[0] if fits else "string"
        for wider in ("bigint", "double"):  # a number that is too wide is not a wrong cell
            if types[c] in ("int", "bigint") and row[f"n{i}_{wider}"] > row[f"n{i}_{types[c]}"]:
                types[c] = wider
        bad[c] = n - row[f"n{i}_{types[c]}"] if fits else 0
    return types, bad, row["_malformed"]


def read_csv_typed(
    spark: SparkSession,
    path: str,
    null_tokens: Sequence[str] = ("",),
    max_bad_share: float = 0.0,
    name: str = "csv",
    staged: list[str] | None = None,
) -> TypedTable:
    """Read a CSV (header row) with types of its own; ``staged`` collects the folder of the columnar copy."""
    columns = spark.read.option("header", "true").csv(path).columns  # the header alone
    fields = ", ".join(f"{ident(c)} STRING" for c in [*columns, MALFORMED])
    text = (
        spark.read.option("header", "true").option("columnNameOfCorruptRecord", MALFORMED).schema(fields).csv(path)
    )
    tokens = [t for t in null_tokens if t != ""]
    if tokens:
        text = text.select(*[F.when(~col(c).isin(tokens), col(c)).alias(c) for c in columns], col(MALFORMED))
    copy = stage_as_parquet(text, name, staged)
    types, bad, lines = choose_types(copy, columns, max_bad_share)
    table = copy.selectExpr(*(f"{as_type(c, types[c])} AS {ident(c)}" for c in columns)) if columns else copy
    wrong = [
        copy.where(f"{ident(c)} IS NOT NULL AND ({as_type(c, types[c])}) IS NULL")
        .selectExpr(f"{lit(c)} AS column", f"{ident(c)} AS cell").groupBy("column", "cell").agg(F.count(F.lit(1)).alias("n"))
        for c in columns if bad[c]
    ]
    none = spark.createDataFrame([], "column string, cell string, n long")
    return TypedTable(table, reduce(DataFrame.unionByName, wrong, none), copy.where(f"{ident(MALFORMED)} IS NOT NULL").selectExpr(f"{ident(MALFORMED)} AS line"), types, bad, lines)
