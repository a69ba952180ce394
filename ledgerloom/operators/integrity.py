"""Integrity of the dictionaries: unknown fields, colliding aliases, weights and thresholds out of range."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def problems(spark: SparkSession, fields: list[str], aliases: dict[str, list[str]], patterns: dict[str, list[str]], critical: list[str], weights: dict[str, float], thresholds: dict[str, float]) -> DataFrame:
    """(kind, name, detail): one row for each problem; none where all is well."""
    known = spark.createDataFrame([(f,) for f in fields], "name string")
    used = spark.createDataFrame([("unknown_alias_field", f) for f in aliases] + [("unknown_pattern_field", f) for f in patterns] + [("unknown_critical_field", f) for f in critical], "kind string, name string")
    unknown = used.join(known, "name", "left_anti").select("kind", "name", F.lit("").alias("detail"))
    pairs = spark.createDataFrame([(a.strip().lower(), f) for f, xs in aliases.items() for a in xs], "name string, field string").distinct()
    collide = pairs.groupBy("name").agg(F.array_join(F.array_sort(F.collect_set("field")), ",").alias("detail"), F.count("*").alias("n")).filter("n > 1").select(F.lit("alias_collision").alias("kind"), "name", "detail")
    nums = spark.createDataFrame([("weight", k, float(v)) for k, v in weights.items()] + [("threshold", k, float(v)) for k, v in thresholds.items()], "what string, name string, v double")
    # counts may be any whole number from 0, shares lie within 0 and 1
    bad = nums.filter("v < 0 or (what = 'threshold' and name not like 'maximum%' and v > 1) or (what = 'threshold' and name like 'maximum%' and v <> floor(v))").select(F.concat_ws("_", F.lit("bad"), "what").alias("kind"), "name", F.col("v").cast("string").alias("detail"))
    return unknown.unionByName(collide).unionByName(bad)


def require_sound(df: DataFrame) -> None:
    rows = df.orderBy("kind", "name").collect()
    if rows:
        raise ValueError("; ".join(f"{r.kind}: {r.name} {r.detail}".strip() for r in rows))
