"""Writers: one partitioned table for each artifact of a processing bundle, JSON and text files, results of a run."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The artifacts of a processing bundle.
BUNDLE = ["document", "raw_elements", "candidates", "resolved_fields", "validation_issues", "document_scores", "summary"]


def sorted_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """A row as JSON with its keys in order."""
    return F.to_json(F.struct(*sorted(columns or df.columns)), {"ignoreNullFields": "false"})


def log_line(df: DataFrame, event: str) -> Column:
    """A row as one compact line of a structured log: its keys and event, in order."""
    return F.to_json(F.struct(*[F.lit(event).alias("event") if c == "event" else F.col(c) for c in sorted({*df.columns, "event"})]))


def bundle(document: DataFrame, raw_elements: DataFrame, candidates: DataFrame, resolved_fields: DataFrame, validation_issues: DataFrame, document_scores: DataFrame) -> dict[str, DataFrame]:
    """The tables of BUNDLE: those given, and a summary with how many rows of each a document and engine have."""
    given = dict(zip(BUNDLE, (document, raw_elements, candidates, resolved_fields, validation_issues, document_scores)))
    counted = [n for n, df in given.items() if {"document_id", "engine_id"} <= set(df.columns)]
    every = None
    for n in counted:
        part = given[n].groupBy("document_id", "engine_id").agg(F.count("*").alias("n")).withColumn("what", F.lit(n))
        every = part if every is None else every.unionByName(part)
    summary = every.groupBy("document_id", "engine_id").agg(*[F.coalesce(F.sum(F.when(F.col("what") == n, F.col("n"))), F.lit(0)).alias(n) for n in counted])
    return given | {BUNDLE[-1]: summary}


def write_bundle(tables: dict[str, DataFrame], path: str, by: str = "engine_id", form: str = "parquet") -> None:
    """tables as path/name, partitioned by engine so that readers of one engine prune the others; path/manifest names them and their columns."""
    for name, df in tables.items():
        w = df.write.mode("overwrite")
        (w.partitionBy(by) if by in df.columns else w).format(form).save(f"{path}/{name}")
    spark = next(iter(tables.values())).sparkSession
    rows = [(n, form, json.dumps(df.dtypes)) for n, df in sorted(tables.items())]
    spark.createDataFrame(rows, "name string, form string, columns string").coalesce(1).write.mode("overwrite").json(f"{path}/manifest")


def write_json(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Rows as JSON lines with their keys in order; by: one folder for each value of these columns."""
    if by:
        df.select(*by, sorted_json(df).alias("value")).write.mode("overwrite").partitionBy(*by).text(path)
    else:
        df.select(sorted_json(df).alias("value")).write.mode("overwrite").text(path)


def write_log(df: DataFrame, path: str, event: str) -> None:
    """Rows as lines of a structured log."""
    df.select(log_line(df, event).alias("value")).write.mode("overwrite").text(path)


def write_review(sheet: DataFrame, path: str) -> None:
    """Review sheets and the templates for their corrections, as two JSON tables under path."""
    write_json(sheet.drop("corrections_template"), f"{path}/review")
    sheet.filter("review_required").select(F.col("corrections_template").alias("value")).write.mode("overwrite").text(f"{path}/corrections")


def write_experiment(path: str, document_metrics: DataFrame, field_metrics: DataFrame, summary: DataFrame, manifest: DataFrame) -> None:
    """The four tables of an experiment, as JSON under path."""
    for name, df in (("document_metrics", document_metrics), ("field_metrics", field_metrics), ("experiment_summary", summary), ("experiment_manifest", manifest)):
        write_json(df, f"{path}/{name}")


def result_of(summary: DataFrame, document_id: str) -> tuple[str, int]:
    """(JSON, exit code) of one document of a summary: 0 where it was processed, 1 where it is unknown or in error."""
    rows = summary.filter(F.col("document_id") == document_id).select(sorted_json(summary).alias("j"), "document_status").limit(1).collect()
    if not rows:
        return json.dumps({"document_id": document_id, "document_status": "unknown"}), 1
    return rows[0].j, int(rows[0].document_status == "error")
