"""Row-level verdicts: which rules does each row break, and the split into passed and quarantined rows.

``row_verdicts`` tags every row with the positions of the rules that it breaks, in one pass over the
table: rules on values are conditions of the row itself. Uniqueness needs the other rows: a value's
digest is counted once (map-side combined), a bitmap of fixed size over the repeated digests is
broadcast, and only rows that it does not rule out are joined with the repeated digests; all others
go straight through, so a clean table is not shuffled at all. That join is by digest with one row a
digest on the other side, so a value in a third of all rows is a skewed join, which adaptive
execution splits.

``quarantine`` writes both parts in that same pass and counts the rows by rule from what it wrote.

Rules: expectations on values (not null, unique, in set, between, lengths) and ``RowRule`` conditions
in SQL. Rules on the whole table (row count, column list) say nothing about a row and are left out.
``mostly`` is a property of the suite's result, not of a row: a row that breaks a rule breaks it.

Edge cases: null cells break the not-null rule only, as in validation; a condition that is null breaks a
``RowRule``; every row of a repeated value breaks uniqueness; a rule on a missing column, of the wrong type
or that cannot be resolved is *unusable* - it is reported with a message and tags no row; an error while a
condition is evaluated (a division by zero) is the caller's to avoid with ``try_divide`` and the like; an
empty table gives two empty parts; a table column named like the added ones is an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.functions.sql import ident
from assay.operators import expectations as X
from assay.operators.analyzers import _unresolved
from assay.operators.membership import bitmap, with_maybe
from assay.operators.states import state_key

FAILED = "failed_rules"
PART = "verdict"
PASSED, QUARANTINED = "passed", "quarantined"


@dataclass(frozen=True)
class RowRule:
    """A SQL condition that every row has to meet."""

    label: str
    condition: str


Rule = X.Expectation | RowRule


def rule_label(rule: Rule) -> str:
    return rule.label if isinstance(rule, RowRule) else f"{rule.expectation_type}({rule.column})"


def unusable(df: DataFrame, rule: Rule) -> str | None:
    """Why a rule cannot tag rows of ``df``, from the schema alone."""
    if isinstance(rule, RowRule):
        return _unresolved(df, f"({rule.condition}) AS p")
    if rule.column is None:
        return f"{rule.expectation_type} is a rule on the whole table"
    return next((p for a in rule.analyzers() if (p := a.problem(df))), None)


def broken(rule: Rule) -> str | None:
    """SQL condition under which a row breaks the rule (None for uniqueness)."""
    if isinstance(rule, RowRule):
        return f"NOT coalesce({rule.condition}, false)"
    c = ident(rule.column)
    if rule.expectation_type == X.NOT_NULL:
        return f"{c} IS NULL"
    condition = rule.unexpected()
    return None if condition is None else f"{c} IS NOT NULL AND ({condition})"


def digest_of(df: DataFrame, column: str) -> str:
    """A text that is equal for equal values: the digest of a wide value, the text of any other."""
    key = state_key(column, df.schema[column].dataType)
    return f"hex({key})"


def repeated_digests(df: DataFrame, column: str) -> DataFrame:
    """``_digest`` of every value of ``column`` that occurs more than once."""
    return (
        df.where(f"{ident(column)} IS NOT NULL").selectExpr(f"{digest_of(df, column)} AS _digest").groupBy("_digest")
        .agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_digest")
    )


def row_verdicts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All rows and columns of ``df`` plus ``failed_rules``, the positions of the rules that a row breaks, in order."""
    if clash := {FAILED, PART} & {c.lower() for c in df.columns}:
        raise ValueError(f"the table has a column {sorted(clash)[0]}")
    columns = [F.col(ident(c)) for c in df.columns]
    usable = [(i, r) for i, r in enumerate(rules) if unusable(df, r) is None]
    tags = [f"CASE WHEN {b} THEN {i} END" for i, r in usable if (b := broken(r)) is not None]
    own = f"filter(CAST(array({', '.join(tags)}) AS ARRAY<INT>), x -> x IS NOT NULL)" if tags else "CAST(array() AS ARRAY<INT>)"
    out = df.select(*columns, F.expr(own).alias(FAILED))
    for i, r in usable:
        if broken(r) is not None:
            continue
        again = repeated_digests(df, r.column)
        digest = f"CASE WHEN {ident(r.column)} IS NOT NULL THEN {digest_of(df, r.column)} END"
        keyed = with_maybe(out.withColumn("_digest", F.expr(digest)), F.col("_digest"), bitmap(again, "_digest"), "_maybe")
        looked = keyed.where("_maybe").join(again.withColumn("_again", F.lit(True)), "_digest", "left")
        looked = looked.withColumn(FAILED, F.expr(f"if(_again, array_append({FAILED}, {i}), {FAILED})"))
        rest = keyed.where("NOT _maybe")
        out = rest.select(*columns, FAILED).unionByName(looked.select(*columns, FAILED))
    return out.withColumn(FAILED, F.array_sort(FAILED))


RULE_COUNTS = T.StructType(
    [
        T.StructField("seq", T.IntegerType()),
        T.StructField("rule", T.StringType()),
        T.StructField("failed_rows", T.LongType()),
        T.StructField("message", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Split:
    """The two parts of a table, as written, and the rows by rule."""

    passed: DataFrame
    quarantined: DataFrame  # with ``failed_rules``
    counts: DataFrame  # RULE_COUNTS: rules that cannot be used have no count, but a message


def quarantine(df: DataFrame, rules: Sequence[Rule], path: str, fmt: str = "parquet") -> Split:
    """Write passed and quarantined rows of ``df`` below the new folder ``path``, in one pass."""
    spark, rules = df.sparkSession, list(rules)
    tagged = row_verdicts(df, rules)
    part = F.when(F.size(FAILED) > 0, QUARANTINED).otherwise(PASSED)
    tagged.withColumn(PART, part).write.partitionBy(PART).format(fmt).save(path)
    schema = T.StructType([*tagged.schema.fields, T.StructField(PART, T.StringType())])
    written = spark.read.schema(schema).format(fmt).load(path)
    bad = written.where(F.col(PART) == QUARANTINED).drop(PART)
    named = spark.createDataFrame(
        [(i, rule_label(r), unusable(df, r)) for i, r in enumerate(rules)], "seq int, rule string, message string"
    )
    found = bad.select(F.explode(FAILED).alias("seq")).groupBy("seq").agg(F.count(F.lit(1)).alias("n"))
    # at most a row for each rule: a bounded broadcast
    counts = named.join(F.broadcast(found), "seq", "left")
    counts = counts.selectExpr("seq", "rule", "CASE WHEN message IS NULL THEN coalesce(n, 0L) END AS failed_rows", "message")
    return Split(written.where(F.col(PART) == PASSED).drop(PART, FAILED), bad, counts)
