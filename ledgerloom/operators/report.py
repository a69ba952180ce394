"""What a document, an engine and a run come to: scores, review sheets, summaries, reports, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dictionary import DEFAULT, Config
from .experiment import filled

KEY = ["document_id", "engine_id"]


def document_scores(fields: DataFrame, completeness: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(document_id, engine_id, coverage, average_confidence, completeness, score): the score is the mean of the parts there are.

    coverage: share of the critical fields that have a value (1 where none is critical). completeness: (document_id,
    completeness), any number, brought into 0 to 1; null where the document has none.
    """
    critical = F.col("field_name").isin(config.critical) if config.critical else F.lit(False)
    n = len(config.critical)
    g = fields.groupBy(*KEY).agg((F.count_if(critical & filled()) / n if n else F.lit(1.0)).alias("coverage"), F.avg(F.when(filled(), F.col("confidence"))).alias("average_confidence"))
    c = completeness.groupBy("document_id").agg(F.max(F.least(F.greatest("completeness", F.lit(0.0)), F.lit(1.0))).alias("completeness"))
    parts = F.array_compact(F.array("coverage", "average_confidence", "completeness"))
    score = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / F.size(parts)
    return g.join(c, "document_id", "left").withColumn("score", score)


def document_summary(fields: DataFrame, issues: DataFrame) -> DataFrame:
    """Counts of a document's fields by status and issues by severity, and its own status: error, conflict or processed."""
    f = fields.groupBy(*KEY).agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("resolved", "missing", "conflict")])
    i = issues.groupBy(*KEY).agg(*[F.count_if(F.col("severity") == s).alias(s) for s in ("info", "warning", "error")])
    same = [F.col(f"f.{k}").eqNullSafe(F.col(f"i.{k}")) for k in KEY]
    out = f.alias("f").join(i.alias("i"), same, "left").select("f.*", *[F.coalesce(f"i.{s}", F.lit(0)).alias(s) for s in ("info", "warning", "error")])
    status = F.when(F.col("error") > 0, "error").when(F.col("conflict") > 0, "conflict").otherwise("processed")
    return out.withColumn("document_status", status)


def review_sheet(fields: DataFrame, issues: DataFrame, least: float | None = None, config: Config = DEFAULT) -> DataFrame:
    """One row a document: what a reviewer should look at, as (field, reason) counts and the sorted fields to correct.

    least: the confidence below which a resolved field is looked at.
    """
    least = config.thresholds["minimum_field_confidence"] if least is None else least
    low = (F.col("status") == "resolved") & F.col("value").isNotNull() & (F.col("confidence") < least)
    a = fields.select(*KEY, "field_name", low.cast("int").alias("low"), (F.col("status") == "conflict").cast("int").alias("conflict"), F.lit(0).alias("issue"))
    b = issues.select(*KEY, "field_name", F.lit(0).alias("low"), F.lit(0).alias("conflict"), F.lit(1).alias("issue"))
    every = a.unionByName(b).withColumn("low", F.coalesce("low", F.lit(0)))
    # at most one name for each canonical field
    names = F.array_sort(F.collect_set(F.when(F.col("low") + F.col("conflict") + F.col("issue") > 0, F.col("field_name"))))
    g = every.groupBy(*KEY).agg(F.sum("low").alias("low_confidence_fields"), F.sum("conflict").alias("conflicts"), F.sum("issue").alias("validation_issues"), names.alias("review_candidates"))
    template = F.to_json(F.struct("document_id", F.transform("review_candidates", lambda f: F.struct(f.alias("field_name"), F.lit("").alias("corrected_value"), F.lit("").alias("notes"))).alias("corrections")))
    return g.withColumn("review_required", F.size("review_candidates") > 0).withColumn("corrections_template", template)


def engine_summary(fields: DataFrame, scores: DataFrame, timings: DataFrame | None = None) -> DataFrame:
    """One row an engine: documents, fill and conflict means, document statuses as a map, mean times where timings are given.

    timings: (document_id, engine_id, stages: map of stage to milliseconds).
    """
    g = scores.groupBy("engine_id").agg(
        F.count("*").alias("documents"), F.avg("resolved").alias("average_resolved"), F.avg(F.when(F.col("document_status") != "processed", 1.0).otherwise(0.0)).alias("review_rate"),
        *[F.count_if(F.col("document_status") == s).alias(f"documents_{s}") for s in ("error", "conflict", "processed")],
    )
    if timings is not None:
        t = timings.select("engine_id", total_time(F.col("stages")).alias("ms"), F.try_element_at("stages", F.lit("preprocessing")).alias("pre"))
        t = t.groupBy("engine_id").agg(F.round(F.avg("ms"), 3).alias("average_ms"), F.round(F.avg("pre"), 3).alias("average_preprocessing_ms"), F.round(F.avg(F.col("ms") - F.coalesce("pre", F.lit(0.0))), 3).alias("average_engine_ms"))
        g = g.join(t, "engine_id", "left")
    return g


def total_time(stages: Column) -> Column:
    """Sum of the stages' milliseconds, three decimals."""
    return F.bround(F.aggregate(F.map_values(stages), F.lit(0.0), lambda a, x: a + x), 3)


def manifest(spark, run: str, engines: list[str], documents: int, tables: list[str]) -> DataFrame:
    """One row that says what a run was made of."""
    return spark.createDataFrame([(run, sorted(engines), documents, sorted(tables))], "run string, engines array<string>, documents long, tables array<string>")


def detail(fields: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Resolved fields with group and place in the dictionary's order, for a table of a document."""
    order = fields.sparkSession.createDataFrame([(i, f, d["category"], f in config.critical) for i, (f, d) in enumerate(config.fields.items())], "place int, field_name string, category string, critical boolean")
    return fields.join(F.broadcast(order), "field_name").select(*KEY, "place", "category", "field_name", "critical", "value", "status")


def report_lines(metrics: DataFrame) -> DataFrame:
    """(engine_id, line): one line of text for each field of an engine that was filled, in conflict or scored."""
    seen = metrics.filter("n_filled > 0 or n_conflict > 0 or n_evaluated > 0")
    line = F.format_string("%-32s fill %5.1f%% conflict %5.1f%% correct %s", "field_name", F.col("fill_rate") * 100, F.col("conflict_rate") * 100, F.when(F.col("correctness_rate").isNotNull(), F.format_string("%5.1f%%", F.col("correctness_rate") * 100)).otherwise("n/a"))
    return seen.select("engine_id", line.alias("line"))
