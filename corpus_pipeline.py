"""Training-data pipeline over ``documents``: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm import decontaminate, jaccard_join, packing, secrets, toxicity
from assay.llm.common import table, written


#: The near-duplicate stage: words a shingle, and the least similarity as a fraction (op4 has its own).
NEAR = (5, 80, 100)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the toxicity classifier rejects; it is fitted on the stage's own documents."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    private = {c: f"_doc_{i}" for i, c in enumerate(docs.columns) if c.lower() in ("score", "predicted")}
    kept = toxicity.score(docs.withColumnsRenamed(private), model).where("predicted = 0")
    return kept.select(*(F.col(f"`{private.get(c, c)}`").alias(c) for c in docs.columns))


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each component of near duplicates, and every row without an id.

    Rows are compared one by one, also those that repeat an id. The first row stays, by id, then by
    the hash of the text, then by the JSON of the other columns; repeats of (doc_id, text) go.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    order = ["doc_id", F.xxhash64("text").alias("_h"), F.to_json(F.struct(*rest)).alias("_rest") if rest else F.lit("").alias("_rest"), "_row"]
    known = docs.where("doc_id IS NOT NULL")
    # numbers of rows are only names here: which one a row gets does not change what stays
    rows = written(known.withColumn("_row", F.monotonically_increasing_id()), "rows")
    groups = jaccard_join.near_duplicates(rows.selectExpr("_row AS doc_id", "text"), *NEAR).selectExpr("doc_id AS _row", "component_id")
    places = rows.select(*order).join(groups, "_row")
    # one row of each component, then one of each (doc_id, text) among them (rows without words are components of their own)
    kept = places.groupBy("component_id").agg(F.min(F.struct("doc_id", "_h", "_rest", "_row")).alias("m")).select("m.*")
    kept = kept.groupBy("doc_id", "_h").agg(F.min(F.struct("_rest", "_row")).alias("m")).select("m._row")
    stay = rows.join(kept, "_row", "left_semi").select(docs.columns)
    return stay.unionByName(docs.where("doc_id IS NULL"))


def decontamination_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark window."""
    hits = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    bad = hits.where("contaminated").select(F.col("doc_id").alias("_bad"))
    return docs.join(bad, docs["doc_id"] == bad["_bad"], "left_anti").select(docs.columns)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask every secret; n_chars follows the masked text."""
    masked = secrets.redacted(docs, secrets.fit(docs))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.length("text").cast(kind))
    return masked.select(docs.columns)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the remaining documents into training sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicate_filter),
    ("decontamination", decontamination_filter),
    ("secrets", secret_redaction),
    ("packing", sequence_packing),
]

#: Trained models and hash-dealt packing groups have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
