"""The pN_ queries: every operator over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import leakage, markup, names, ocr, packing, pii, splitting, survivors, unicode_forms
from .common import table


def _rows(df: DataFrame, source: str, key: str, field: str) -> DataFrame:
    """(source_table, row_key, field_name, loaded_at, text) of one field: every delivery."""
    return df.select(F.lit(source).alias("source_table"), F.col(key).cast("long").alias("row_key"), F.lit(field).alias("field_name"), "loaded_at", F.col(field).alias("text"))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    key = pii.session_key(spark)
    a = pii.found(table(spark, sf, "raw_artifacts"), "artifact_id", ["text"], "raw_artifacts", key)
    b = pii.found(table(spark, sf, "candidates"), "cand_id", ["line_text", "context_text"], "candidates", key)
    return a.unionByName(b)


def p1_redacted(spark: SparkSession, sf: str) -> DataFrame:
    a = _rows(table(spark, sf, "raw_artifacts"), "raw_artifacts", "artifact_id", "text")
    c = table(spark, sf, "candidates")
    for field in ("line_text", "context_text"):
        a = a.unionByName(_rows(c, "candidates", "cand_id", field))
    return pii.redacted(a, {"text": "redacted_text"}, pii.session_key(spark)).drop("text")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return markup.found(table(spark, sf, "raw_artifacts"))


def p2_clean(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "raw_artifacts").select("artifact_id", "loaded_at", "text", "raw_label")
    return markup.cleaned(a).drop("text", "raw_label")


def p2_wrapped(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "raw_artifacts").select(F.col("artifact_id").alias("row_key"), "text", "source_engine")
    return markup.induce_wrappers(a, ["source_engine"])


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return ocr.found(table(spark, sf, "raw_artifacts"), table(spark, sf, "candidates"))


def p3_reflowed(spark: SparkSession, sf: str) -> DataFrame:
    return ocr.reflowed(table(spark, sf, "raw_artifacts"), table(spark, sf, "candidates"))


def p3_repaired(spark: SparkSession, sf: str) -> DataFrame:
    return ocr.repaired_fields(table(spark, sf, "raw_artifacts"), table(spark, sf, "candidates"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    a = unicode_forms.found(table(spark, sf, "raw_artifacts"), "artifact_id", "text", "raw_artifacts")
    b = unicode_forms.found(table(spark, sf, "candidates"), "cand_id", "value", "candidates")
    return a.unionByName(b)


def p4_normalized(spark: SparkSession, sf: str) -> DataFrame:
    a = _rows(table(spark, sf, "raw_artifacts"), "raw_artifacts", "artifact_id", "text")
    b = _rows(table(spark, sf, "candidates"), "candidates", "cand_id", "value")
    return unicode_forms.normalized(a.unionByName(b), "text", "normalized_text").drop("text")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return survivors.found(table(spark, sf, "candidates"))


def p5_fused(spark: SparkSession, sf: str) -> DataFrame:
    return survivors.fused(table(spark, sf, "candidates"))


def p5_built(spark: SparkSession, sf: str) -> DataFrame:
    out = survivors.built(table(spark, sf, "candidates"))
    return out.withColumn("bounding_box", F.to_json("bounding_box"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return names.found(names.names_of(table(spark, sf, "candidates")))


def p6_entities(spark: SparkSession, sf: str) -> DataFrame:
    return names.entities(names.names_of(table(spark, sf, "candidates")))


def p7_packed(spark: SparkSession, sf: str) -> DataFrame:
    return packing.packed(table(spark, sf, "documents"), table(spark, sf, "size_limits"))


def p7_kept(spark: SparkSession, sf: str) -> DataFrame:
    """What an assignment must keep: every document placed whole unless it exceeds the size, no container over it."""
    docs, limits = table(spark, sf, "documents"), table(spark, sf, "size_limits")
    return packing.kept(packing.packed(docs, limits), docs, limits)


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.found(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def p9_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.split(table(spark, sf, "documents"), table(spark, sf, "size_limits"))


def p9_rebuilt(spark: SparkSession, sf: str) -> DataFrame:
    """Every document put together again from its pieces without their overlaps (for each limit; documents that fit, as they are): signs and digest, blanks aside."""
    docs, limits = table(spark, sf, "documents"), table(spark, sf, "size_limits")
    return splitting.rebuilt(splitting.split(docs, limits), docs, limits)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: f for n, f in globals().items() if n[0] == "p" and n[1:2].isdigit() and callable(f)}


def oracle_sql() -> dict[str, str]:
    from .oracle import SQL

    return dict(SQL)
