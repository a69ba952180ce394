"""Elements to lines, and lines to sections."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dictionary import PARTY_DETAIL, PHRASES, SERVICE_DETAIL, VALUE_DETAIL
from ..functions.text import any_phrase, digit_density, has_phrase, is_blank, norm

KEY = ["document_id", "engine_id"]
#: What lines are made of.
COLUMNS = ["document_id", "engine_id", "ordinal", "element_id", "text", "page_number", "bounding_box", "confidence", "block_num", "line_num"]
#: Sections in the order that settles equal scores.
SECTIONS = ["ignored_billing", "provider", "recipient", "service", "values", "header"]
#: Lines of one block of the section fold.
BLOCK = 2_000


def normalized(elements: DataFrame, key: str = "element_id") -> DataFrame:
    """Elements of any engine under common names: hints as numbers (blank ones null), an unnamed engine as unknown; trace holds what they were made of."""
    number = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).try_cast("int")
    label = F.nullif(F.trim("raw_label"), F.lit(""))
    trace = F.to_json(F.struct(*sorted(c for c in elements.columns if c != key)))
    return elements.select(
        key, F.coalesce(F.nullif("source_engine", F.lit("")), F.lit("unknown")).alias("source_engine"), F.col("element_type").alias("source_element_type"), F.col("text").alias("raw_text"),
        number("block_num").alias("block_hint"), number("line_num").alias("line_hint"), number("word_num").alias("word_hint"), label.alias("label_hint"), trace.alias("trace"),
    )


def build_lines(elements: DataFrame) -> DataFrame:
    """Lines of elements: by (page, block, line) where both are known, else by a twelve-point step of y.

    Within a line elements go by x; lines go by page, top, left, first element. The ordinal settles ties. Lines are
    numbered page by page and pages by a running sum of their line counts, so a long document is spread over its
    pages. words holds the elements of a line, n_lines the lines of its document.
    """
    box = F.col("bounding_box")
    e = elements.filter(~is_blank(F.col("text"))).withColumn("page", F.coalesce("page_number", F.lit(1)))
    hinted = F.col("block_num").isNotNull() & F.col("line_num").isNotNull()
    e = e.withColumn("b", F.when(hinted, F.col("block_num"))).withColumn("l", F.when(hinted, F.col("line_num")).otherwise(F.bround(F.coalesce(box.y, F.lit(0.0)) / 12).cast("int")))
    element_id = F.col("element_id") if "element_id" in elements.columns else F.lit(None).cast("string")
    word = F.struct(F.coalesce(box.x, F.lit(0.0)).alias("x"), "ordinal", F.trim(F.regexp_replace("text", r"(?U)^\s+|\s+$", "")).alias("text"), "confidence", element_id.alias("element_id"))
    g = e.groupBy(*KEY, "page", "b", "l").agg(
        F.array_sort(F.collect_list(word)).alias("words"), F.min(F.coalesce(box.y, F.lit(0.0))).alias("top"), F.min(F.coalesce(box.x, F.lit(0.0))).alias("left"),
        F.min("ordinal").alias("first"), F.min(box.x).alias("bx"), F.min(box.y).alias("by"), F.max(box.x + box.w).alias("br"), F.max(box.y + box.h).alias("bb"), F.avg("confidence").alias("confidence"),
    )
    w = Window.partitionBy(*KEY, "page").orderBy("top", "left", "first", "b", "l")
    on_page = g.withColumn("at", F.row_number().over(w)).withColumn("on_page", F.count("*").over(Window.partitionBy(*KEY, "page")))
    # one row a page: how many lines stand before it
    pages = on_page.filter("at = 1").select(*KEY, "page", "on_page")
    sums = Window.partitionBy(*KEY).orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    pages = pages.select(*KEY, "page", F.coalesce(F.sum("on_page").over(sums), F.lit(0)).alias("before"), F.sum("on_page").over(Window.partitionBy(*KEY)).alias("n_lines"))
    same = [F.col(f"g.{k}").eqNullSafe(F.col(f"p.{k}")) for k in (*KEY, "page")]
    g = on_page.alias("g").join(pages.alias("p"), same).select("g.*", "p.before", "p.n_lines")
    union = F.when(F.col("bx").isNotNull(), F.struct(F.col("bx").alias("x"), F.col("by").alias("y"), (F.col("br") - F.col("bx")).alias("w"), (F.col("bb") - F.col("by")).alias("h")))
    number = (F.col("before") + F.col("at") - 1).cast("int")
    return g.select(*KEY, number.alias("line_index"), F.col("page").alias("page_number"), F.col("b").alias("block_num"), F.array_join(F.transform("words", lambda x: x["text"]), " ").alias("text"), F.size("words").alias("n_words"), union.alias("bounding_box"), "confidence", "words", F.col("n_lines").cast("int").alias("n_lines"))


#: Lines of one part of a document where windows look ahead or back.
PART = 1_024


def in_parts(lines: DataFrame, ahead: int, keys: list[str] | None = None, order: str = "line_index") -> tuple[DataFrame, list[str]]:
    """(lines with part and own, keys of a part): each part of PART lines with the first `ahead` lines of the next one.

    Windows over a part see what they need; rows that are not own are dropped afterwards. A long document is many parts.
    """
    keys = keys or KEY
    here = F.floor(F.col(order) / PART).cast("int")
    borrowed = F.when((F.col(order) % PART < ahead) & (here > 0), F.array(F.struct(here.alias("part"), F.lit(True).alias("own")), F.struct((here - 1).alias("part"), F.lit(False).alias("own"))))
    both = F.coalesce(borrowed, F.array(F.struct(here.alias("part"), F.lit(True).alias("own"))))
    return lines.withColumn("_p", F.explode(both)).select(*[c for c in lines.columns], "_p.part", "_p.own"), [*keys, "part"]


def with_next(lines: DataFrame, most: int, columns: list[str]) -> DataFrame:
    """lines with next: the given columns of the following lines, at most `most`, in order."""
    parts, keys = in_parts(lines, most)
    w = Window.partitionBy(*keys).orderBy("line_index").rowsBetween(1, most)
    return parts.withColumn("next", F.collect_list(F.struct(*columns)).over(w)).filter("own").drop("part", "own")


def section_scores(normal: Column) -> dict[str, Column]:
    """Score of each section: the sum of its phrases; dense numbers near billing words count for billing."""
    out = {}
    for s in SECTIONS:
        parts = [F.when(has_phrase(normal, p), F.lit(n)).otherwise(0) for p, n in PHRASES[s].items()]
        out[s] = reduce(lambda a, b: a + b, parts)
    dense = (digit_density(normal) > 0.55) & (normal.contains("vencimento") | normal.contains("documento") | normal.contains("pagamento"))
    out["ignored_billing"] = out["ignored_billing"] + F.when(dense, 3).otherwise(0)
    return out


def score_sections(lines: DataFrame) -> DataFrame:
    """lines with normal, section_explicit, section_score and section_phrases (what spoke for it); a line of score 0 is header."""
    lines = lines.withColumn("normal", norm(F.col("text")))
    scores = section_scores(F.col("normal"))
    lines = lines.withColumns({f"s_{s}": c for s, c in scores.items()})
    best = F.greatest(*[F.col(f"s_{s}") for s in SECTIONS])
    pick = reduce(lambda acc, s: acc.when(F.col(f"s_{s}") == best, F.lit(s)), SECTIONS[1:], F.when(best == 0, F.lit("header")).when(F.col(f"s_{SECTIONS[0]}") == best, F.lit(SECTIONS[0])))
    lines = lines.withColumn("section_explicit", pick).withColumn("section_score", best).drop(*[f"s_{s}" for s in SECTIONS])
    n = F.col("normal")
    dense = (digit_density(n) > 0.55) & (n.contains("vencimento") | n.contains("documento") | n.contains("pagamento"))
    spoke = reduce(
        lambda acc, s: acc.when(F.col("section_explicit") == s, F.array_compact(F.array(*[F.when(has_phrase(n, p), F.lit(p)) for p in PHRASES[s]], *([F.when(dense, F.lit("numeric_billing_density"))] if s == "ignored_billing" else [])))),
        SECTIONS[1:],
        F.when(F.col("section_score") == 0, F.array().cast("array<string>")).when(F.col("section_explicit") == SECTIONS[0], F.array_compact(F.array(*[F.when(has_phrase(n, p), F.lit(p)) for p in PHRASES[SECTIONS[0]]], F.when(dense, F.lit("numeric_billing_density"))))),
    )
    return lines.withColumn("section_phrases", spoke)


def line_features(lines: DataFrame) -> DataFrame:
    """Scored lines with the predicates of the section rules."""
    n = F.col("normal")
    return lines.withColumns(
        {
            "party": any_phrase(n, PARTY_DETAIL),
            "service_like": any_phrase(n, SERVICE_DETAIL),
            "value_like": any_phrase(n, VALUE_DETAIL),
            "municipal": n.contains("prefeitura") | n.contains("secretaria") | n.startswith("municipio de "),
        }
    )


def step(state: tuple[str, bool, bool], explicit: str, score: int, party: bool, service: bool, value: bool, municipal: bool) -> tuple[str, float, str]:
    """(section, confidence, rule) of a line after a state (section, recipient seen, service seen)."""
    current, saw_recipient, saw_service = state
    if explicit == "ignored_billing" and score >= 3:
        return "ignored_billing", 0.95, ""
    if explicit in ("provider", "recipient", "service", "values") and score >= 3:
        return explicit, 0.92, ""
    if current == "ignored_billing" and explicit not in ("header", "provider", "recipient", "service"):
        return "ignored_billing", 0.75, "billing_continuation"
    if party and current in ("provider", "recipient"):
        return current, 0.78, f"{current}_detail_continuation"
    if party and current == "header" and not (saw_recipient or saw_service or municipal):
        return "provider", 0.72, "implicit_provider_before_recipient"
    if service and current == "service":
        return "service", 0.72, "service_detail_continuation"
    if value and current in ("service", "values"):
        return "values", 0.72, "value_detail_continuation"
    if explicit == "header" and score >= 2:
        return "header", 0.85, ""
    if score > 0 and explicit in ("provider", "recipient", "service", "values"):
        return explicit, 0.62, ""
    return ("header" if current == "ignored_billing" else current), 0.55, "section_continuation"


STATES = [(s, r, v) for s in SECTIONS for r in (False, True) for v in (False, True)]
START = ("header", False, False)


def _next(state: tuple[str, bool, bool], section: str) -> tuple[str, bool, bool]:
    return section, state[1] or section == "recipient", state[2] or section == "service"


FEATURES = ["section_explicit", "section_score", "party", "service_like", "value_like", "municipal"]


def classify_sections(lines: DataFrame, block: int = BLOCK) -> DataFrame:
    """lines with section, section_confidence, section_rule and section_reasons: an ordered fold over each document.

    There are 24 states, so a block of lines is a map from states to states. The blocks of long documents are folded
    in parallel, their maps (one short row a block) are composed along the document in one ordered stream, and each
    block is run again from its own first state: a document of any length never stands in one task.
    """
    scored = line_features(score_sections(lines)).withColumn("block_no", (F.col("line_index") / block).cast("int"))
    key = [*KEY, "block_no"]

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        last, states = None, []
        for b in batches:
            for k0, k1, k2, *f in zip(*(b.column(c).to_pylist() for c in [*key, *FEATURES])):
                if (k0, k1, k2) != last:
                    if last is not None:
                        out.append((*last, [STATES.index(x) for x in states]))
                    last, states = (k0, k1, k2), list(STATES)
                states = [_next(x, step(x, *f)[0]) for x in states]
        if last is not None:
            out.append((*last, [STATES.index(x) for x in states]))
        cols = list(zip(*out)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.list_(pa.int32()))], names=[*key, "next"])

    # only documents of several blocks need maps; the first block of any begins at the start
    cells = scored.filter(F.col("n_lines") > block).select(*key, "line_index", *FEATURES)
    maps = cells.repartition(*key).sortWithinPartitions(*key, "line_index").drop("line_index").mapInArrow(tables, "document_id string, engine_id string, block_no int, next array<int>")

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, state = None, 0
        for b in batches:
            begin = []
            for k0, k1, m in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist()):
                if (k0, k1) != doc:
                    doc, state = (k0, k1), STATES.index(START)
                begin.append(state)
                state = m[state]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(begin, pa.int32())], names=[*key, "state"])

    begins = maps.repartition(*KEY).sortWithinPartitions(*key).mapInArrow(chain, "document_id string, engine_id string, block_no int, state int")
    keep = [c for c in scored.columns if c not in ("block_no", "party", "service_like", "value_like", "municipal")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, START
        for b in batches:
            sections, confidences, rules = [], [], []
            for k0, k1, k2, begin, *f in zip(*(b.column(c).to_pylist() for c in [*key, "state", *FEATURES])):
                if (k0, k1, k2) != last:
                    last, state = (k0, k1, k2), STATES[begin]
                r = step(state, *f)
                state = _next(state, r[0])
                sections.append(r[0])
                confidences.append(r[1])
                rules.append(r[2])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(sections, pa.string()), pa.array(confidences, pa.float64()), pa.array(rules, pa.string())], names=[*keep, "section", "section_confidence", "section_rule"])

    kinds = dict(scored.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", section string, section_confidence double, section_rule string"
    ready = scored.join(begins, key, "left").withColumn("state", F.coalesce("state", F.lit(STATES.index(START))))
    ready = ready.select(*dict.fromkeys([*key, "line_index", *keep, *FEATURES, "state"]))
    # a shuffle of its own: one by the join's keys would be left out, and adaptive execution may spread the join's rows anew
    own = ready.repartition(F.xxhash64(*key))
    out = own.sortWithinPartitions(*key, "line_index").mapInArrow(run, schema)
    # the phrases of a line's own section, then the rule that kept it elsewhere
    rule = F.when(F.col("section_rule") != "", F.array("section_rule")).otherwise(F.array().cast("array<string>"))
    return out.withColumn("section_reasons", F.array_distinct(F.concat("section_phrases", rule))).drop("section_phrases")


def party_marker(lines: DataFrame) -> DataFrame:
    """lines with party: the nearest provider or recipient heading at or before each (a backward as-of).

    Within parts of a document by window; what a part ends with is carried on over the parts (one row a part).
    """
    n = norm(F.col("text"))
    mark = F.when(n.startswith("prestador"), F.lit("provider")).when(n.startswith("tomador"), F.lit("recipient"))
    lines = lines.withColumn("part", F.floor(F.col("line_index") / PART).cast("int")).withColumn("_mark", mark)
    w = Window.partitionBy(*KEY, "part").orderBy("line_index")
    lines = lines.withColumn("party", F.last("_mark", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    ends = lines.groupBy(*KEY, "part").agg(F.max_by("_mark", F.when(F.col("_mark").isNotNull(), F.col("line_index"))).alias("_end"))
    before = Window.partitionBy(*KEY).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*KEY, "part", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in (*KEY, "part")]
    out = lines.alias("a").join(ends.alias("b"), same).select("a.*", "b._carried")
    return out.withColumn("party", F.coalesce("party", "_carried")).drop("_mark", "_carried", "part")
