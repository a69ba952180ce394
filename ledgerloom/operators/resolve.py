"""Competing candidates to one value a field: every candidate is weighed as evidence for every field."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dictionary import AMBIGUITY, DEFAULT, MINIMUM_CONFIDENCE, WEIGHTS, Config
from ..functions.text import squash

TOTAL = WEIGHTS["alias"] + WEIGHTS["pattern"] + WEIGHTS["positional"] + WEIGHTS["section"] + WEIGHTS["engine"]


def _any(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds, F.lit(False))


def field_scores(config: Config = DEFAULT, evidence: bool = False) -> Column:
    """An array of (field_name, score; with what it rests on if evidence) over the canonical fields, from columns f, label, section, context, value.

    A literal array instead of a join: the candidate's texts are normalised once, and no row is multiplied
    before its scores are known.
    """
    w = config.weights
    top = w["alias"] + w["pattern"] + w["positional"] + w["section"] + w["engine"]
    # patterns are shared by many fields: each distinct list is tried once
    lists = {tuple(p): i for i, p in enumerate({tuple(p): None for p in config.patterns.values()})}
    out = []
    for name, d in config.fields.items():
        category = d["category"]
        aliases = sorted({name, *[" ".join(a.lower().split()) for a in config.extra_labels.get(name, [])]})
        alias = F.when(F.col("f").isin(aliases) | F.col("label").isin(aliases), 1.0).when(F.col("context").isin(aliases), 0.7).otherwise(0.0)
        pattern = F.col(f"p{lists[tuple(config.patterns[name])]}") if name in config.patterns else F.lit(0.0)
        section = F.col(f"k_{category}")
        conflict = {"provider": F.col("section").contains("tomador"), "recipient": F.col("section").contains("prestador")}.get(category, F.lit(False))
        total = alias * w["alias"] + pattern * w["pattern"] + F.col("pos") * w["positional"] + section * w["section"] + F.coalesce("confidence", F.lit(0.0)) * w["engine"] - F.when(conflict, w["conflict"]).otherwise(0.0)
        parts = [alias.alias("alias_match"), pattern.alias("pattern_match"), F.col("pos").alias("positional_match"), section.alias("section_match"), conflict.alias("section_conflict")] if evidence else []
        out.append(F.struct(F.lit(name).alias("field_name"), F.greatest(F.least(total / top, F.lit(1.0)), F.lit(0.0)).alias("score"), *parts))
    return F.array(*out)


EVIDENCE = ["alias_match", "pattern_match", "positional_match", "section_match", "section_conflict"]


def scored(candidates: DataFrame, config: Config = DEFAULT, evidence: bool = False) -> DataFrame:
    """(document_id, engine_id, cand_id, candidate_ordinal, confidence, value, field_name, score; EVIDENCE if wanted), score > 0.

    A label_distance, where there is one, counts by its nearness within 200 points.
    """
    block = F.when(F.coalesce("same_block_as_label", F.lit(False)) | F.coalesce(F.col("block_num") == F.col("label_block_num"), F.lit(False)), config.weights["same_block"]).otherwise(0.0)
    near = F.greatest(F.lit(0.0), 1 - F.least(F.col("label_distance") / 200, F.lit(1.0))) if "label_distance" in candidates.columns else F.lit(0.0)
    c = candidates.select(
        "document_id", "engine_id", "cand_id", "candidate_ordinal", "confidence", "value", squash(F.col("field_name")).alias("f"), squash(F.col("label_text")).alias("label"),
        squash(F.col("section_name")).alias("section"), squash(F.col("context_text")).alias("context"),
        F.greatest(block, F.coalesce(near, F.lit(0.0))).alias("pos"),
    )
    v = F.coalesce(F.col("value"), F.lit(""))
    lists = list({tuple(p): None for p in config.patterns.values()})
    c = c.withColumns({f"p{i}": F.when(_any([v.rlike(x) for x in p]), 1.0).otherwise(0.0) for i, p in enumerate(lists)})
    c = c.withColumns({f"k_{k}": F.when(_any([F.col("section").contains(x) for x in ws]), 1.0).when(_any([F.col("context").contains(x) for x in ws]), 0.5).otherwise(0.0) for k, ws in config.section_keywords.items()})
    s = c.select("document_id", "engine_id", "cand_id", "candidate_ordinal", "confidence", "value", F.explode(F.filter(field_scores(config, evidence), lambda x: x["score"] > 0)).alias("s"))
    return s.select("document_id", "engine_id", "cand_id", "candidate_ordinal", "confidence", "value", "s.field_name", "s.score", *([f"s.{e}" for e in EVIDENCE] if evidence else []))


KEY = ["document_id", "engine_id", "field_name"]


def places(scores: DataFrame) -> DataFrame:
    """scores with place: the candidates of a field from the best; ties (up to the noise of doubles) go to the earlier candidate."""
    w = Window.partitionBy(*KEY).orderBy(F.desc(F.round("score", 9)), F.asc_nulls_last("candidate_ordinal"), "cand_id")
    return scores.withColumn("place", F.row_number().over(w))


def resolved(scores: DataFrame, count: bool = False) -> DataFrame:
    """One row a document, engine and field: the best candidate, its value where nothing speaks against it, its status.

    count: with n_candidates, at the price of a second pass over the scores.

    Of every field only the two best places are kept, before the shuffle already, so a field with many candidates
    is neither sorted whole nor listed.
    """
    top = places(scores).filter("place <= 2")
    o = F.struct("score", F.coalesce("confidence", F.lit(0.0)).alias("conf"), "value", "cand_id")
    both = top.groupBy(*KEY).agg(F.max(F.when(F.col("place") == 1, o)).alias("a"), F.max(F.when(F.col("place") == 2, o)).alias("b"))
    close = (F.abs(F.col("a.score") - F.col("b.score")) <= AMBIGUITY) & (F.abs(F.col("a.conf") - F.col("b.conf")) <= AMBIGUITY)
    ambiguous = F.coalesce(close, F.lit(False))
    low = F.col("a.score") < MINIMUM_CONFIDENCE
    out = both.select(*KEY, F.col("a.cand_id").alias("selected_id"), F.when(~(ambiguous | low), F.col("a.value")).alias("value"), F.when(ambiguous | low, "conflict").otherwise("resolved").alias("status"), F.col("a.score").alias("confidence"), ambiguous.alias("ambiguous"), low.alias("low_confidence"), F.col("b").isNotNull().alias("contested"))
    if count:
        n = scores.groupBy(*KEY).agg(F.count("*").alias("n_candidates"))
        same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in KEY]
        out = out.alias("a").join(n.alias("b"), same).select("a.*", "b.n_candidates")
    return out
