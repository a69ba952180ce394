"""Checks of values by type and name, missing fields, corrections and their merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dictionary import FIELDS, UFS
from ..functions.text import digits
from ..functions.values import date, decimal, percentage, valid_document


def dictionary(spark) -> DataFrame:
    return spark.createDataFrame([(f, c, t, r) for f, (c, t, r) in FIELDS.items()], "field_name string, category string, type string, required boolean")


def missing_fields(fields: DataFrame, docs: DataFrame, keys: list[str], required: DataFrame) -> DataFrame:
    """(keys, field_name): required fields that a document has no row of (an anti join; the grid is docs x required)."""
    grid = docs.select(*keys).distinct().crossJoin(F.broadcast(required.filter("required").select("field_name")))
    return grid.join(fields.filter("value is not null and trim(value) <> ''").select(*keys, "field_name").distinct(), [*keys, "field_name"], "left_anti")


def value_issues(field: Column, value: Column, as_of: str) -> Column:
    """Codes of what is wrong with a value, by its field's type and name."""
    kind = F.try_element_at(F.create_map(*[F.lit(x) for f, (_, t, _r) in FIELDS.items() for x in (f, t)]), field)
    d, m, p = date(value), decimal(value), percentage(value)
    phone = F.length(digits(value))
    rules = [
        ((kind == "document_id") & ~valid_document(value), "invalid_document_id"),
        ((kind == "date") & d.isNull(), "invalid_date_format"),
        ((kind == "date") & (d > F.lit(as_of).cast("date")), "implausible_future_date"),
        ((kind == "date") & (F.year(d) < 2000), "implausible_historic_date"),
        ((kind == "decimal") & m.isNull(), "invalid_monetary_value"),
        ((kind == "decimal") & (m < 0), "negative_monetary_value"),
        ((kind == "percentage") & p.isNull(), "invalid_percentage"),
        ((kind == "percentage") & ((p < 0) | (p > 100)), "implausible_percentage"),
        ((field == "service_code") & ~value.rlike(r"^\d{1,4}(\.\d{1,2})?$"), "invalid_service_code"),
        (field.endswith("_email") & ~value.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"), "invalid_email"),
        (field.endswith("_phone") & ~phone.between(10, 13), "invalid_phone"),
        (field.endswith("_uf") & ~F.upper(F.trim(value)).isin(UFS), "invalid_uf"),
    ]
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in rules]))


#: Checks in order, with what they say. {f} is the field. An error where the field is required if severity is None.
CHECKS = [
    ("required_field_missing", "error", "Required field {f} is missing."),
    ("field_conflict", None, "Field {f} has competing values."),
    ("required_field_unresolved", "error", "Required field {f} has no safe value."),
    ("field_missing", "warning", "Field {f} is marked as missing."),
    ("invalid_document_id", None, "Field {f} holds no valid CPF or CNPJ."),
    ("invalid_email", "warning", "Field {f} holds no valid mailbox."),
    ("invalid_phone", "warning", "Field {f} holds no plausible phone number."),
    ("invalid_uf", "warning", "Field {f} holds no state of the country."),
    ("invalid_date_format", "error", "Field {f} holds no valid date."),
    ("implausible_future_date", "warning", "Field {f} is later than the day of processing."),
    ("implausible_historic_date", "warning", "Field {f} is implausibly early."),
    ("invalid_service_code", "warning", "Field {f} holds no valid service code."),
    ("invalid_monetary_value", None, "Field {f} holds no valid amount."),
    ("negative_monetary_value", None, "Field {f} holds a negative amount."),
    ("invalid_percentage", "warning", "Field {f} holds no valid share."),
    ("implausible_percentage", "warning", "Field {f} holds a share outside 0 to 100."),
    ("provider_recipient_document_equal", "warning", "Provider and recipient have one document number."),
]


def issues(fields: DataFrame, keys: list[str], as_of: str) -> DataFrame:
    """(keys, field_name, code): one row for each thing wrong with a resolved value. Conflicts are not looked into."""
    sound = "value is not null and trim(value) <> ''" + (" and status = 'resolved'" if "status" in fields.columns else "")
    return fields.filter(sound).select(*keys, "field_name", F.explode(value_issues(F.col("field_name"), F.col("value"), as_of)).alias("code"))


def validation(fields: DataFrame, keys: list[str], as_of: str) -> DataFrame:
    """(keys, rule_order, field_name, code, severity, message) of every check: missing fields first, then by field, then between fields.

    fields: with status (resolved, conflict, missing) and value. A field in conflict, marked missing, or required and blank is not looked into further.
    """
    spark = fields.sparkSession
    known = F.broadcast(dictionary(spark).select("field_name", "required", F.monotonically_increasing_id().alias("_no")))  # the dictionary: tens of rows
    docs = fields.select(*keys).distinct()
    grid = docs.crossJoin(F.broadcast(dictionary(spark).filter("required").select("field_name")))
    same = [F.col(f"g.{k}").eqNullSafe(F.col(f"f.{k}")) for k in (*keys, "field_name")]
    absent = grid.alias("g").join(fields.select(*keys, "field_name").distinct().alias("f"), same, "left_anti").withColumn("code", F.lit("required_field_missing"))
    d = fields.join(known, "field_name", "left")
    required, blank = F.coalesce("required", F.lit(False)), F.col("value").isNull() | (F.trim("value") == "")
    first = (
        F.when(F.col("status") == "conflict", "field_conflict").when((F.col("status") == "missing") & required, "required_field_unresolved").when(F.col("status") == "missing", "field_missing")
        .when(required & blank, "required_field_unresolved")
    )
    codes = F.when(first.isNotNull(), F.array(first)).when(~blank, value_issues(F.col("field_name"), F.trim("value"), as_of))
    own = d.select(*keys, "field_name", F.explode(codes).alias("code"))
    doc = lambda f: F.max(F.when((F.col("field_name") == f) & (F.col("status") == "resolved"), F.nullif(digits(F.col("value")), F.lit(""))))
    both = fields.groupBy(*keys).agg(doc("provider_document").alias("p"), doc("recipient_document").alias("r")).filter("p = r")
    equal = both.select(*keys, F.lit("recipient_document").alias("field_name"), F.lit("provider_recipient_document_equal").alias("code"))
    rules = F.broadcast(spark.createDataFrame([(i, c, s, m) for i, (c, s, m) in enumerate(CHECKS)], "_rule int, code string, severity string, message string"))
    every = absent.select(*keys, "field_name", "code").unionByName(own).unionByName(equal).join(rules, "code").join(known, "field_name", "left")
    severity = F.coalesce("severity", F.when(F.coalesce("required", F.lit(False)), "error").otherwise("warning"))
    block = F.when(F.col("code") == "required_field_missing", 0).when(F.col("code") == "provider_recipient_document_equal", 2).otherwise(1)
    order = F.format_string("%d:%s:%02d", block, F.col("field_name"), F.col("_rule"))
    return every.select(*keys, order.alias("rule_order"), "field_name", "code", severity.alias("severity"), F.replace(F.col("message"), F.lit("{f}"), F.col("field_name")).alias("message"))


def last_corrections(corrections: DataFrame) -> DataFrame:
    """The last correction of every field (by time, then text); blank values correct nothing."""
    at = F.coalesce(F.try_to_timestamp("reviewed_at", F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp("reviewed_at", F.lit("yyyy-MM-dd'T'HH:mm:ss")), F.try_to_timestamp("reviewed_at", F.lit("yyyy-MM-dd")), F.try_to_timestamp("reviewed_at", F.lit("dd/MM/yyyy HH:mm")), F.try_to_timestamp("reviewed_at", F.lit("dd/MM/yyyy")))
    c = corrections.filter("corrected_value is not null and trim(corrected_value) <> ''")
    o = F.struct(F.coalesce(F.unix_seconds(at), F.lit(0)).alias("at"), F.col("corrected_value").alias("v"))
    return c.groupBy("document_id", "field_name").agg(F.max(o).alias("m")).select("document_id", "field_name", F.col("m.v").alias("corrected_value"))


def corrected(fields: DataFrame, corrections: DataFrame) -> DataFrame:
    """Fields with corrections merged in: a full outer join; a corrected field is resolved and loses its confidence."""
    m = fields.join(corrections, ["document_id", "field_name"], "full_outer")
    has = F.col("corrected_value").isNotNull()
    return m.select("document_id", "field_name", F.coalesce("corrected_value", "value").alias("value"), F.when(has, "resolved").otherwise(F.col("status")).alias("status"), F.when(~has, F.col("confidence")).alias("confidence"), F.when(has, F.col("value")).alias("previous_value"))
