"""Comparison of engines: fill, conflict and correctness by field and document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dictionary import CRITICAL, FIELDS
from .quality import dictionary


def filled() -> Column:
    return (F.col("status") == "resolved") & F.col("value").isNotNull() & (F.trim("value") != "")


def field_metrics(fields: DataFrame, docs: DataFrame, expected: DataFrame, same) -> DataFrame:
    """One row for every engine and canonical field: fill, conflict and correctness rates.

    docs: (engine_id, document_id) processed. same(value, expected) compares. Sums are made before the grid
    of engines and fields is joined, so the grid never meets the rows.
    """
    n = docs.distinct().groupBy("engine_id").agg(F.count("*").alias("documents"))
    e = fields.join(expected, ["document_id", "field_name"], "left")
    known = F.col("expected_value").isNotNull()
    right = known & F.coalesce(filled() & same(F.col("value"), F.col("expected_value")), F.lit(False))
    sums = e.groupBy("engine_id", "field_name").agg(F.count_if(filled()).alias("n_filled"), F.count_if(F.col("status") == "conflict").alias("n_conflict"), F.count_if(known).alias("n_evaluated"), F.count_if(right).alias("n_correct"))
    grid = n.crossJoin(F.broadcast(dictionary(fields.sparkSession).select("field_name")))
    out = grid.join(sums, ["engine_id", "field_name"], "left").na.fill(0)
    d = F.greatest("documents", F.lit(1))
    return out.select("engine_id", "field_name", "documents", "n_filled", "n_conflict", "n_evaluated", "n_correct", (F.col("n_filled") / d).alias("fill_rate"), (F.col("n_conflict") / d).alias("conflict_rate"), (F.col("n_correct") / F.nullif("n_evaluated", F.lit(0))).alias("correctness_rate"))


def grid(docs: DataFrame, processed: DataFrame) -> DataFrame:
    """(document_id, engine_id, processed): every document with every engine. Engines are few: their number is checked before they are sent around."""
    engines = processed.filter("engine_id is not null").select("engine_id").distinct()
    if engines.limit(1_001).count() > 1_000:
        raise ValueError("more than 1,000 engines")
    every = docs.filter("document_id is not null").select("document_id").distinct().crossJoin(F.broadcast(engines))
    seen = processed.select("document_id", "engine_id").distinct().withColumn("processed", F.lit(True))
    return every.join(seen, ["document_id", "engine_id"], "left").withColumn("processed", F.coalesce("processed", F.lit(False)))


def document_fill(fields: DataFrame) -> DataFrame:
    return fields.groupBy("engine_id", "document_id").agg((F.count_if(filled()) / len(FIELDS)).alias("fill_rate"), F.count_if(F.col("status") == "conflict").alias("conflicts"))


def critical_coverage(fields: DataFrame) -> DataFrame:
    """One row a document and engine: which critical fields it has, and their share."""
    has = {f"has_{f}": F.max(F.when((F.col("field_name") == f) & F.col("value").isNotNull() & (F.trim("value") != ""), 1).otherwise(0)) for f in CRITICAL}
    g = fields.groupBy("engine_id", "document_id").agg(*[c.alias(n) for n, c in has.items()])
    return g.withColumn("coverage", sum((F.col(n) for n in has), F.lit(0)) / len(CRITICAL))
