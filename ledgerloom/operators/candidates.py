"""Candidates: labels and values on lines, value tables, ids, duplicates, ranks and review flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dictionary import ALIASES, MONEY_FIELDS, REVIEW_DEFAULT, REVIEW_THRESHOLDS, SINGLETONS
from ..functions.extract import NO_CODE
from ..functions.text import digits, norm, tokens
from ..functions.values import all_matches, clamp
from .lines import in_parts

# Forms of values (without look-around, so that every engine reads them alike).
MONEY = r"(?:R\$\s*)?\b\d{1,3}(?:\.\d{3})*,\d{2}\b"
DATE = r"\b\d{1,2}/\d{1,2}/\d{4}\b"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"


def alias_table(spark) -> DataFrame:
    """(field_name, alias, first, n): aliases as normal tokens; a small dictionary."""
    rows = sorted({(f, " ".join(a.replace("_", " ").replace("-", " ").split())) for f, xs in ALIASES.items() for a in [*xs, f]})
    return spark.createDataFrame([(f, a, a.split()[0], len(a.split())) for f, a in rows], "field_name string, alias string, first string, n_tokens int")


def label_matches(lines: DataFrame, key: list[str], aliases: DataFrame) -> DataFrame:
    """(key, field_name, alias, start_token, end_token): of every field the label that ends last on every line.

    Of an alias that is there several times the first place counts; of aliases that end alike the longer.

    An equi-join on the alias' first word, then a check of the rest: no line meets every alias.
    """
    t = lines.select(*key, tokens(norm(F.col("text"))).alias("toks")).select(*key, "toks", F.posexplode("toks").alias("start_token", "first"))
    hit = t.join(F.broadcast(aliases), "first").filter(F.array_join(F.slice(F.col("toks"), F.col("start_token") + 1, F.col("n_tokens")), " ") == F.col("alias"))
    hit = hit.withColumn("end_token", F.col("start_token") + F.col("n_tokens") - 1)
    hit = hit.groupBy(*key, "field_name", "alias", "n_tokens").agg(F.min("start_token").alias("start_token"), F.min("end_token").alias("end_token"))
    best = F.max_by(F.struct("alias", "start_token", "end_token"), F.struct("end_token", "n_tokens", (-F.col("start_token")).alias("s"))).alias("m")
    return hit.groupBy(*key, "field_name").agg(best).select(*key, "field_name", "m.*")


def all_values(df: DataFrame, key: str, text: str, pattern: str) -> DataFrame:
    """(key, match_no, value): every match of a pattern."""
    return df.select(key, F.posexplode(all_matches(F.col(text), pattern)).alias("match_no", "value"))


def repaired_email(text: Column) -> Column:
    """A mailbox whose @ was read as another sign; null where none is found."""
    m = r"(?iu:e-?mail|correio eletr[oô]nico)\W{0,4}([a-z0-9._+-]{2,}?) ?(?:©|\((?i:arroba)\)|\[(?i:at)\]|[QO]) ?([a-z0-9-]{2,}(?:\.[a-z0-9-]+)+)"
    user, host = F.regexp_extract(text, m, 1), F.regexp_extract(text, m, 2)
    return F.when((user != "") & ~text.contains("@"), F.lower(F.concat(user, F.lit("@"), host)))


def following(lines: DataFrame, keys: list[str], order: str, most: int, value: Column) -> DataFrame:
    """lines with nearby: the first value on the next `most` lines, and how far it was."""
    parts, key = in_parts(lines.withColumn("_v", value), most, keys, order)
    w = Window.partitionBy(*key).orderBy(order)
    ahead = [F.lead("_v", k).over(w) for k in range(1, most + 1)]
    away = reduce(lambda acc, k: acc.when(ahead[k].isNotNull(), F.lit(k + 1)), range(1, most), F.when(ahead[0].isNotNull(), F.lit(1)))
    return parts.withColumn("nearby", F.coalesce(*ahead)).withColumn("distance", away).filter("own").drop("_v", "part", "own")


def nearby_text(lines: DataFrame, keys: list[str], order: str, most: int = 3) -> DataFrame:
    """lines with the joined text of the next lines, for windows of 1 to most lines."""
    parts, key = in_parts(lines, most, keys, order)
    w = Window.partitionBy(*key).orderBy(order)
    nexts = [F.lead("text", k).over(w) for k in range(1, most + 1)]
    return parts.withColumns({f"next_{n}": F.concat_ws(" ", *nexts[:n]) for n in range(1, most + 1)}).filter("own").drop("part", "own")


def candidate_id(doc: Column, field: Column, line: Column, n: Column, value: Column) -> Column:
    return F.concat_ws(":", doc, F.lit("normalizer"), field, line.cast("string"), n.cast("string"), F.substring(F.sha1(F.coalesce(value, F.lit(""))), 1, 12))


def boosted(confidence: Column, source: Column) -> Column:
    """Mean confidence (0.5 where unknown) with the boost of its source, 0 to 1; a repaired mailbox counts less."""
    boost = F.when(source == "financial_table", 0.10).when(source == "regex", 0.03).otherwise(0.08)
    c = clamp(F.coalesce(confidence, F.lit(0.5)) + boost)
    return F.when(source == "ocr_corrected_email", F.least(c * 0.75, F.lit(0.7))).otherwise(c)


CAND_KEY = ["document_id", "engine_id", "field_name"]


def distinct_values(c: DataFrame) -> DataFrame:
    """(document, engine, field, n_values): how many values differ after normalising."""
    return c.filter("value is not null").groupBy(*CAND_KEY).agg(F.countDistinct(norm(F.col("value"))).alias("n_values"))


def deduplicated(c: DataFrame) -> DataFrame:
    """One candidate for each field, normal value and section: the most confident, then the first; one shuffle, no sort."""
    best = F.struct(F.coalesce("confidence", F.lit(0.0)).alias("conf"), (-F.col("candidate_ordinal")).alias("o"), (-F.col("cand_id")).alias("i"))
    keep = [x for x in c.columns if x not in CAND_KEY]
    g = c.withColumn("_norm", norm(F.col("value"))).withColumn("_section", F.coalesce("section_name", F.lit("")))
    return g.groupBy(*CAND_KEY, "_norm", "_section").agg(F.max_by(F.struct(*keep), best).alias("r"), F.min("candidate_ordinal").alias("first_ordinal")).select(*CAND_KEY, "r.*", "first_ordinal")


def rank_score(c: DataFrame) -> Column:
    """Confidence with what the label and the line say for or against a value of its field."""
    field, value = F.col("field_name"), F.coalesce("value", F.lit(""))
    line, label = norm(F.col("line_text")), norm(F.col("label_text"))
    says = lambda t, *ps: reduce(lambda a, b: a | b, [t.contains(p) for p in ps])
    add = lambda cond, x: F.when(cond, F.lit(x)).otherwise(F.lit(0.0))
    zero = value.rlike(r"\d") & ~value.rlike(r"[1-9]")
    money = field.isin([*MONEY_FIELDS, "iss_rate"])
    base = F.coalesce("confidence", F.lit(0.0))
    dates = add(says(label, "emissao") | says(line, "emissao", "data hora"), 0.45) + add(says(line, "autorizacao", "fato gerador", "rps", "vencimento"), -0.65)
    number = add(says(line, "numero da nota", "numero da nfs", "numero da nf", "nota no"), 0.45) + add(says(line, "rps", "recibo provisorio"), -0.55) - F.least(F.length(digits(value)), F.lit(12)) * 0.005
    code = add(says(line, "codigo de verificacao", "codigo verificador", "certificacao"), 0.5) + add(value.contains("-"), 0.2) + add(F.upper(norm(value)).isin(NO_CODE), -1.0)
    src = F.coalesce("value_source", F.lit(""))
    common = F.when(src == "financial_table", 0.35).when(src == "next_line_table", 0.15).otherwise(0.0) + add(says(line, "credito", "trib federais", "total trib"), -0.45)
    own = (
        F.when(field == "gross_amount", add(says(label, "valor bruto", "valor total", "valor servico"), 0.25))
        .when(field == "taxable_amount", add(says(label, "base"), 0.25))
        .when(field == "iss_rate", add(says(label, "aliquota"), 0.25) + add(zero, -0.85) + add(value.endswith("%"), 0.10))
        .when(field == "iss_amount", add(says(label, "valor iss", "issqn devido"), 0.25))
        .when(field == "net_amount", add(says(label, "valor liquido"), 0.25) + add(says(line, "credito"), -0.55))
        .when(field.isin([f for f in MONEY_FIELDS if f not in ("gross_amount", "taxable_amount", "iss_amount", "net_amount", "iss_withheld_amount")]), add(zero, 0.08))
        .otherwise(0.0)
    )
    return base + F.when(field == "issue_date", dates).when(field == "nfse_number", number).when(field == "verification_code", code).when(money, common + own).otherwise(0.0)


def best_singletons(c: DataFrame) -> DataFrame:
    """Of fields with one value, the candidate of the greatest rank; ties: confidence, then the earlier line and candidate."""
    s = c.filter(F.col("field_name").isin(SINGLETONS)).withColumn("rank_score", F.round(rank_score(c), 6))
    order = F.struct("rank_score", F.coalesce("confidence", F.lit(0.0)).alias("conf"), (-F.coalesce("line_index", F.lit(0))).alias("l"), (-F.col("candidate_ordinal")).alias("o"), (-F.col("cand_id")).alias("i"))
    return s.groupBy(*CAND_KEY).agg(F.max_by(F.struct("cand_id", "value", "rank_score"), order).alias("r")).select(*CAND_KEY, "r.*")


def review_flags(c: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """c with review_reasons (in rule order), review_status and the threshold and count they rest on.

    counts: distinct_values of the candidates before duplicates were dropped; of c where it is not given.
    """
    counts = distinct_values(c) if counts is None else counts
    field, value, src = F.col("field_name"), F.coalesce("value", F.lit("")), F.coalesce("value_source", F.lit(""))
    limit = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in REVIEW_THRESHOLDS.items() for x in p]), field), F.lit(REVIEW_DEFAULT))
    line = norm(F.col("line_text"))
    merged = reduce(lambda a, b: a | b, [line.contains(p) for p in ("credito", "trib federais", "total trib", "linha digitavel")])
    money = field.isin([*MONEY_FIELDS, "iss_rate"])
    rules = [
        (F.col("confidence") < limit, "low_confidence"),
        (F.col("section_confidence") < 0.65, "low_section_confidence"),
        (F.col("section_override_applied"), "section_inferred_from_field"),
        (F.col("n_values") > 1, "multiple_candidates"),
        (src.isin("nearby_line", "nearby_lines"), "nearby_value"),
        (src == "next_line_table", "table_value"),
        (src == "ocr_corrected_email", "email_ocr_corrected"),
        (field.endswith("_email") & F.col("ocr_correction_applied"), "email_ocr_separator_uncertain"),
        ((field == "service_code") & value.rlike(r"^\d{3,4}$"), "service_code_format_uncertain"),
        ((field == "iss_rate") & ~value.endswith("%"), "rate_without_percent"),
        (money & ~src.isin("label_tail", "next_line", "next_line_table", "inline") & merged, "merged_financial_context"),
    ]
    reasons = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in rules]))
    own = ["review_reasons", "review_status", "manual_review_required", "review_confidence_threshold", "candidate_conflict_count"]
    out = c.drop(*own).join(counts, CAND_KEY, "left").withColumn("review_reasons", reasons)
    flagged = F.size("review_reasons") > 0
    return out.withColumns({
        "review_status": F.when(flagged, "needs_review").otherwise("accepted"), "manual_review_required": flagged, "review_confidence_threshold": limit,
        "candidate_conflict_count": F.when(F.col("n_values") > 1, F.col("n_values")),
    })
