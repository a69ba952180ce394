"""Problem 5: one surviving record for every group of records that state the same value.

Values are brought to one notation by field (names: by their entity), and (document, field, value) is a
group. A latent two-sided quality model judges the values: every witness has a sensitivity (how often it
speaks for a true value) and a specificity (how often it is silent about a false one), inferred by
expectation-maximisation without labels. Witnesses are the sources (engine x value on the label's line or
elsewhere), which state a value, are silent about it, or have not read its field; and the respects of a
value's records: sure (confidence), placed (section confidence), fresh (as new as any of the field), full
(no evidence missing). Only (pattern of witnesses, count) is looked at in a round: on the driver while there are
at most PATTERNS of them, else by the workers, with the same result; any number of sources will do.

A field with several values keeps each that is judged true. The survivor of a group is the record of the
greatest score: confidence, section confidence, time and evidence, each weighed by how well its witness was found to
tell true values from false ones; ties go to the greater of these in turn, then to the better source. A record
that nobody beats has the greatest score under any positive weights, so the weights settle the groups in which
records beat each other; `found` keeps the survivors that, checked exactly, nobody beats.

Odd input: null and blank values and headings are in no group; a null confidence counts lowest; exact
repeats are one record (every aggregate is idempotent); a full tie of two records is no case in `found`
and goes to the better source, then the smaller cand_id, in `survivors`; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import names
from .common import MEMO, cut
from .unicode_forms import bare_forms, normalize

NAME_FIELDS = ["provider_name", "recipient_name"]
MULTI = ["provider_phone", "recipient_phone", "provider_email", "recipient_email", "service_description"]
EVIDENCE = ["label_text", "context_text", "line_text", "section_name", "page_number", "bounding_box"]
# Letters read for digits; street types and their abbreviations; months.
DIGITS = str.maketrans("OoQDIl|!SsBZzGg", "000011115582266")
STREET = {"r": "rua", "av": "avenida", "ave": "avenida", "al": "alameda", "tv": "travessa", "pca": "praca", "rod": "rodovia", "estr": "estrada", "lgo": "largo", "qd": "quadra", "lt": "lote", "no": "", "n": "", "numero": ""}
MONTHS = "janeiro fevereiro marco abril maio junho julho agosto setembro outubro novembro dezembro".split()


def _decimal(s: str) -> str | None:
    s = re.sub(r"^R\$|[\s%]|R\$", "", s)
    if re.search(r"[A-Za-z|!]", s):
        s = s.translate(DIGITS)
    s = re.sub(r"[^\d,.-]", "", s)
    if not any(c.isdigit() for c in s):
        return None
    if "," in s and "." in s:
        s = s.replace(".", "").replace(",", ".") if s.rfind(",") > s.rfind(".") else s.replace(",", "")
    elif "," in s:
        s = s.replace(",", ".") if s.count(",") == 1 else s.replace(",", "")
    elif s.count(".") > 1 or re.fullmatch(r"-?\d{1,3}\.\d{3}", s):
        s = s.replace(".", "")
    try:
        return f"{float(s):.4f}".rstrip("0").rstrip(".")
    except ValueError:
        return None


def _date(s: str, low: str) -> str | None:
    m = re.search(r"(\d{4})\s?[-/.]\s?(\d{1,2})\s?[-/.]\s?(\d{1,2})(?!\d)", s)
    if m:
        return f"{int(m[1]):04}-{int(m[2]):02}-{int(m[3]):02}"
    m = re.search(r"(\d{1,2})\s?[-/.]\s?(\d{1,2})\s?[-/.]\s?(\d{4}|\d{2})(?!\d)", s)
    if m:
        y = int(m[3]) + (2000 if len(m[3]) == 2 else 0)
        return f"{y:04}-{int(m[2]):02}-{int(m[1]):02}"
    m = re.search(r"(\d{1,2}) (?:de )?([a-z]+) (?:de )?(\d{4})", low)
    if m and m[2] in MONTHS:
        return f"{m[3]}-{MONTHS.index(m[2]) + 1:02}-{int(m[1]):02}"
    fixed = s.translate(DIGITS)
    return _date(fixed, low) if fixed != s else None


def value_key(name: str, value: str, low: str) -> str | None:
    """One notation for the values of a field (name); value is in its consistent form, low is its bare form."""
    v = value.strip()
    if not v:
        return None
    if name.endswith("_amount"):
        return _decimal(v)
    if name.endswith("_rate"):
        v = v.replace("%", "").strip()
        return _decimal(v if "," in v else v.replace(".", ","))
    if name.endswith("_date"):
        return _date(v, low)
    if name.endswith("_document"):
        d = re.sub(r"\D", "", re.sub(r"[A-Za-z]", lambda m: m.group().translate(DIGITS), v) if len(re.sub(r"\D", "", v)) not in (11, 14) else v)
        return d or None
    if name.endswith("_phone"):
        d = re.sub(r"\D", "", v)
        d = d[2:] if len(d) > 11 and d.startswith("55") else d
        return d.lstrip("0") or None
    if name.endswith("_number"):
        d = re.sub(r"\D", "", re.sub(r"^\s*n\W{0,3}(?:nfs-?e)?", "", low))
        return d.lstrip("0") or d or None
    if name.endswith("_code") and name != "service_code":
        return re.sub(r"[^A-Z0-9]", "", v.upper()) or None
    if name == "service_code":
        return re.sub(r"\D", "", v).lstrip("0") or None
    if name.endswith("_email"):
        s = re.sub(r"[(\[{<]\s*(?:arroba|at|a)\s*[)\]}>]| arroba | at |©", "@", v)
        if "@" not in s:
            s = re.sub(r"^([a-z0-9._+-]+) ?[QO0] ?([a-z0-9-]+\.)", r"\1@\2", s)
        s = re.sub(r"[(\[]?\s*\b(?:ponto|dot)\b\s*[)\]]?", ".", s)
        return re.sub(r"\s", "", s).lower().strip(".,;") or None
    if name.endswith("_uf"):
        return re.sub(r"[^a-z]", "", low) or None
    words = re.findall(r"[a-z0-9]+", low.replace("º", " ").replace("°", " "))
    if name.endswith("_address"):
        words = [x for w in words if (x := STREET.get(w, w))]
    return " ".join(words) or None


def keyed(df: DataFrame, keep: list[str]) -> DataFrame:
    """df's keep columns with vkey, the value in one notation (null where there is none)."""
    schema = ", ".join(f"`{n}` {t}" for n, t in df.select(*keep).dtypes) + ", vkey string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for b in batches:
            if not b.num_rows:
                continue
            field = b.column("field_name").to_pylist()
            raw = b.column("value").to_pylist()
            new = [k for k in dict.fromkeys(zip(field, raw)) if k not in memo]
            if len(memo) > MEMO:
                memo.clear()
                new = list(dict.fromkeys(zip(field, raw)))
            normal = normalize(pa.array([v for _, v in new], pa.large_string()))[0]
            low = bare_forms(normal)[0].to_pylist()
            for k, v, x in zip(new, normal.to_pylist(), low):
                memo[k] = value_key(k[0], v, x) if k[0] and v else None
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array([memo[k] for k in zip(field, raw)], pa.string())], names=[*keep, "vkey"])

    return df.select(*keep).mapInArrow(run, schema)


def grouped(candidates: DataFrame) -> DataFrame:
    """Every record with its vkey and the columns of the comparison; records without a value are left out."""
    bits = sum((F.when(F.col(c).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(EVIDENCE)), F.lit(0))
    line = F.when(F.col("value_source") == "same_line", "line").otherwise("other")
    base = candidates.select(
        "cand_id", "document_id", "field_name", "value", F.coalesce("confidence", F.lit(-1.0)).alias("conf"), F.coalesce("section_confidence", F.lit(-1.0)).alias("sec"),
        F.coalesce(F.unix_micros(F.col("loaded_at").cast("timestamp")), F.lit(-(2**62)).cast("long")).alias("at"), bits.cast("int").alias("bits"),
        F.concat_ws("/", F.coalesce("engine_id", F.lit("?")), line).alias("source"),
    )
    keep = ["cand_id", "document_id", "field_name", "conf", "sec", "at", "bits", "source"]
    other = keyed(base.filter(~F.col("field_name").isin(NAME_FIELDS)), [*keep, "value"]).drop("value")
    who = names.entities(names.names_of(candidates))
    named = base.filter(F.col("field_name").isin(NAME_FIELDS)).join(who, "value").select(*keep, F.col("entity").alias("vkey"))
    return other.filter("vkey is not null").unionByName(named)


RESPECTS = ["sure", "placed", "fresh", "full"]
#: Confidence and section confidence from which a respect speaks for a value.
SURE, PLACED = 0.85, 0.85
#: Patterns of witnesses that the driver holds.
PATTERNS = 100_000
#: Least weight of a respect: none counts against its record.
LEAST = 0.05


@dataclass
class Quality:
    """What was inferred: {witness: (sensitivity, specificity)}, weights of the respects, the span of time."""

    sources: dict[str, tuple[float, float]] = field(default_factory=dict)
    respects: dict[str, tuple[float, float]] = field(default_factory=dict)
    weights: dict[str, float] = field(default_factory=lambda: dict.fromkeys(RESPECTS, 1.0))
    span: tuple[int, int] = (0, 1)

    def trust(self, source: str) -> float:
        a, b = self.sources.get(source, (0.5, 0.5))
        return float(np.log(a / (1 - b)))


def _signs(patterns: list[str], index: dict[str, int]) -> np.ndarray:
    """One row a pattern, one column a witness: 0 no word, 1 silent, 2 speaks for the value."""
    x = np.zeros((len(patterns), len(index)), np.int8)
    for r, p in enumerate(patterns):
        for sign, part in zip((2, 1), p.split("\n")):
            for w in part.split("\t") if part else ():
                x[r, index[w]] = sign
    return x


def _posterior(x: np.ndarray, sens: np.ndarray, spec: np.ndarray, prior: float) -> np.ndarray:
    seen, said = x > 0, x == 2
    t = np.log(prior) + (seen * np.where(said, np.log(sens), np.log1p(-sens))).sum(1)
    f = np.log1p(-prior) + (seen * np.where(said, np.log1p(-spec), np.log(spec))).sum(1)
    return 1 / (1 + np.exp(np.clip(f - t, -500, 500)))


def _expect(x: np.ndarray, n: np.ndarray, sens: np.ndarray, spec: np.ndarray, prior: float) -> np.ndarray:
    """Sums of one round: for each witness (true & said, true & seen, false & silent, false & seen), then (true, all)."""
    p = _posterior(x, sens, spec, prior)
    w, v = (n * p)[:, None], (n * (1 - p))[:, None]
    seen, said = x > 0, x == 2
    return np.concatenate([(w * said).sum(0), (w * seen).sum(0), (v * (seen & ~said)).sum(0), (v * seen).sum(0), [(n * p).sum(), n.sum()]])


def witnessed(records: DataFrame) -> DataFrame:
    """(document_id, field_name, vkey, pattern) of every value: the witnesses for it, a line break, those silent about it."""
    values = records.groupBy("document_id", "field_name", "vkey").agg(
        F.collect_set("source").alias("said"), F.max("conf").alias("conf"), F.max("sec").alias("sec"), F.max("at").alias("at"),  # a set is at most the sources
        F.max(F.bit_count("bits")).alias("bits"),
    )
    read = values.groupBy("document_id", "field_name").agg(F.array_distinct(F.flatten(F.collect_set("said"))).alias("read"), F.max("at").alias("newest"))
    both = values.join(read, ["document_id", "field_name"])
    tests = {"sure": (F.col("conf") >= SURE, F.col("conf") >= 0), "placed": (F.col("sec") >= PLACED, F.col("sec") >= 0), "fresh": (F.col("at") == F.col("newest"), F.lit(True)), "full": (F.col("bits") == len(EVIDENCE), F.lit(True))}
    yes = F.array_compact(F.array(*[F.when(known & c, F.lit(f"*{r}")) for r, (c, known) in tests.items()]))
    no = F.array_compact(F.array(*[F.when(known & ~c, F.lit(f"*{r}")) for r, (c, known) in tests.items()]))
    sign = lambda a, b: F.array_join(F.concat(F.array_sort(a), b), "\t")
    pattern = F.concat(sign(F.col("said"), yes), F.lit("\n"), sign(F.array_except("read", "said"), no))
    return both.select("document_id", "field_name", "vkey", pattern.alias("pattern"))


def source_quality(records: DataFrame, rounds: int = 30, held: int = PATTERNS) -> tuple[Quality, DataFrame]:
    """(what was inferred of sources and respects, values with p_true) by expectation-maximisation."""
    none = -(2**62)
    low, high, names_ = records.agg(F.min(F.when(F.col("at") > none, F.col("at"))), F.max("at"), F.array_sort(F.collect_set("source"))).first()
    if not names_:
        return Quality(), records.select("document_id", "field_name", "vkey", F.lit(None).cast("double").alias("p_true"))
    witnesses = [*names_, *(f"*{r}" for r in RESPECTS)]
    index = {w: i for i, w in enumerate(witnesses)}
    k = len(witnesses)
    values = cut(witnessed(records))
    counts = values.groupBy("pattern").count()
    got = counts.limit(held + 1).collect()
    if len(got) <= held:
        x, n = _signs([r[0] for r in got], index), np.array([r[1] for r in got], float)
        sums = lambda *q: _expect(x, n, *q)
    else:
        counts = cut(counts)

        def sums(*q):
            def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for b in batches:
                    yield pa.RecordBatch.from_arrays([pa.array([_expect(_signs(b.column(0).to_pylist(), index), np.asarray(b.column(1), float), *q).tolist()], pa.list_(pa.float64()))], names=["s"])

            # one short row a batch of patterns
            return np.sum([r[0] for r in counts.mapInArrow(part, "s array<double>").collect()], axis=0)

    sens, spec, prior = np.full(k, 0.8), np.full(k, 0.7), 0.6
    for _ in range(rounds):
        s = sums(sens, spec, prior)
        a, b, c, d = s[:k], s[k : 2 * k], s[2 * k : 3 * k], s[3 * k : 4 * k]
        sens = np.clip((a + 4) / (b + 5), 0.02, 0.98)
        spec = np.clip((c + 3.5) / (d + 5), 0.02, 0.98)
        prior = float(np.clip(s[-2] / s[-1], 0.02, 0.98))
    both = {w: (float(sens[i]), float(spec[i])) for w, i in index.items()}
    respects = {r: both.pop(f"*{r}") for r in RESPECTS}
    weights = {r: max(LEAST, float(np.log(a * b / ((1 - a) * (1 - b))))) for r, (a, b) in respects.items()}

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = _posterior(_signs(b.column("pattern").to_pylist(), index), sens, spec, prior)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("document_id", "field_name", "vkey")), pa.array(p)], names=["document_id", "field_name", "vkey", "p_true"])

    judged = values.mapInArrow(judge, "document_id string, field_name string, vkey string, p_true double")
    return Quality(both, respects, weights, (low if low is not None else 0, max(high, (low or 0) + 1))), judged


def scored(records: DataFrame, quality: Quality) -> DataFrame:
    """records with score (respects by their weights) and q (trust in their source)."""
    w, (low, high) = quality.weights, quality.span
    time = (F.greatest(F.col("at"), F.lit(low)) - F.lit(low)) / F.lit(float(high - low))
    score = F.greatest("conf", F.lit(0.0)) * w["sure"] + F.greatest("sec", F.lit(0.0)) * w["placed"] + time * w["fresh"] + F.bit_count("bits") / len(EVIDENCE) * w["full"]
    trust = {s: quality.trust(s) for s in quality.sources}
    known = records.sparkSession.createDataFrame(list(trust.items()), "source string, q double")  # one row a source
    return records.withColumn("score", score).join(F.broadcast(known), "source", "left").withColumn("q", F.coalesce("q", F.lit(0.0)))


def survivors(records: DataFrame, quality: Quality) -> DataFrame:
    """(document_id, field_name, vkey, group_id, survivor_id, several, sole): one row a group.

    sole: the survivor is beaten by none in any respect and is the only such record. One shuffle with
    partial aggregation: a group of any size is never gathered.
    """
    rank = lambda *last: F.struct("conf", "sec", "at", F.bit_count("bits").alias("seen"), "bits", *last)
    best = F.struct("score", "conf", "sec", "at", F.bit_count("bits").alias("seen"), "bits", "q", (-F.col("cand_id")).alias("c"))
    g = scored(records, quality).groupBy("document_id", "field_name", "vkey").agg(
        F.min("cand_id").alias("group_id"), F.max("cand_id").alias("last_id"), F.max("conf").alias("conf"), F.max("sec").alias("sec"), F.max("at").alias("at"), F.bit_or("bits").alias("bits"),
        F.max(best).alias("best"), F.max(rank(F.col("cand_id").alias("c"))).alias("high"), F.max(rank((-F.col("cand_id")).alias("c"))).alias("first"),
    )
    sole = (F.col("high.c") == -F.col("first.c")) & (F.col("best.conf") == F.col("conf")) & (F.col("best.sec") == F.col("sec")) & (F.col("best.at") == F.col("at")) & (F.col("best.bits") == F.col("bits"))
    return g.select("document_id", "field_name", "vkey", "group_id", (-F.col("best.c")).alias("survivor_id"), (F.col("group_id") < F.col("last_id")).alias("several"), sole.alias("sole"))


def found(candidates: DataFrame) -> DataFrame:
    """(group_id, survivor_id) of groups of two or more whose survivor nobody beats."""
    records = cut(grouped(candidates))
    quality, _ = source_quality(records)
    return survivors(records, quality).filter("several and sole").select("group_id", "survivor_id")


def fused(candidates: DataFrame) -> DataFrame:
    """(document_id, field_name, vkey, group_id, survivor_id, p_true): the values kept of every field.

    A field with several values keeps every value judged true (at least 0.5); another field keeps its most
    probable value (ties: the smaller group_id).
    """
    records = cut(grouped(candidates))
    quality, values = source_quality(records)
    best = survivors(records, quality).join(values, ["document_id", "field_name", "vkey"])
    top = best.groupBy("document_id", "field_name").agg(F.max(F.struct("p_true", (-F.col("group_id")).alias("g")))["g"].alias("g"))
    kept = best.join(top, ["document_id", "field_name"]).filter((F.col("group_id") == -F.col("g")) | (F.col("field_name").isin(MULTI) & (F.col("p_true") >= 0.5)))
    return kept.select("document_id", "field_name", "vkey", "group_id", "survivor_id", F.round("p_true", 6).alias("p_true"))


def built(candidates: DataFrame) -> DataFrame:
    """A record built field by field for every group: each attribute from the record of the greatest score that has it.

    Of a record delivered several times the latest delivery counts, whole.
    """
    records = cut(grouped(candidates))
    quality, _ = source_quality(records)
    at = F.coalesce(F.unix_micros(F.col("loaded_at").cast("timestamp")), F.lit(-(2**62)).cast("long"))
    latest = candidates.select("cand_id", at.alias("at"), *EVIDENCE, "value").groupBy("cand_id").agg(F.max(F.struct("at", *EVIDENCE, "value")).alias("r")).select("cand_id", *[F.col(f"r.{c}").alias(c) for c in (*EVIDENCE, "value")])
    best = scored(records, quality).groupBy("cand_id", "document_id", "field_name", "vkey").agg(F.max(F.struct("at", "score", "conf")).alias("m")).select("cand_id", "document_id", "field_name", "vkey", "m.*")
    both = best.join(latest, "cand_id")
    pick = [F.max(F.when(F.col(c).isNotNull(), F.struct("score", "at", "cand_id", F.col(c).alias("v"))))["v"].alias(c) for c in ("value", *EVIDENCE)]
    return both.groupBy("document_id", "field_name", "vkey").agg(F.min("cand_id").alias("group_id"), F.max("conf").alias("confidence"), *pick)
