"""Candidates from lines: labels and what stands after, beside or below them, patterns without a label, value tables.

Everything is an expression over one row a line (with its words and the next lines' features); rows are multiplied
only when the labels of a line are exploded. The first step that gives a value names its source.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions.dictionary import DEFAULT, Config
from ..functions.text import let, norm, tokens
from ..functions.values import all_matches, clamp, document_mask
from ..sources.shared import cut
from . import candidates as C
from . import fintable
from .lines import KEY, build_lines, classify_sections, with_next

SOURCE = "normalizer"
# Labels whose field depends on the party; words that end a value; fields by how they are looked for.
PARTY_LABELS = {
    "cnpj cpf": "document", "cpf cnpj": "document", "nome razao social": "name", "razao social": "name", "razao social nome": "name",
    "insc municipal": "municipal_registration", "inscricao municipal": "municipal_registration", "endereco": "address", "email": "email", "e mail": "email",
    "telefone": "phone", "fone": "phone", "uf": "uf",
}
STOPS = ["aliquota", "bairro", "base", "cep", "cnpj", "cofins", "compl", "cpf", "data", "deducoes", "desconto", "email", "emissao", "endereco", "fone", "inss", "insc", "inscricao", "irrf", "iss", "municipal", "municipio", "natureza", "nome", "numero", "pais", "pis", "prrf", "serie", "social", "telefone", "tomador", "uf", "valor"]
NO_LABEL = {("nfse_number", "nfs e"), ("nfse_number", "nfse"), ("provider_name", "prestador"), ("recipient_name", "tomador"), ("iss_amount", "iss")}
SERVICE_TEXTS = ["operation_nature", "service_city", "service_description"]
SERVICE_ONLY = ["operation_nature", "service_city", "service_code"]
FREE_TEXT = ["provider_address", "recipient_address"]
NEARBY = ["issue_date", "verification_code", "operation_nature", "service_code"]
FINANCE_WORDS = ["aliquota", "base de calculo", "valor total", "valor iss", "valor liquido", "vencimento"]
PARTY_WORDS = ["bairro", "e mail", "email", "endereco", "fantasia", "municipio", "nome razao", "pais", "razao social", "social", "telefone"]


def kept(df: DataFrame, condition: Column) -> DataFrame:
    """df where the condition holds, tested where it stands: the optimizer would else push it below the columns it is made of and write their expressions out again and again."""
    fixed = df.withColumn("_ok", condition).withColumn("_here", F.monotonically_increasing_id())
    return fixed.filter("_ok and _here >= 0").drop("_ok", "_here")


def label_table(config: Config = DEFAULT) -> list[tuple[int, str | None, str, str, int, str | None]]:
    """(rank, field, label as written, its words, their number, what of a party): labels with more words first, party labels last.

    Equal word sequences of one field keep the first spelling in order of the alphabet.
    """
    rows = []
    for name in config.fields:
        seen: dict[str, str] = {}
        for label in sorted({name.replace("_", " "), *config.known_labels[name]}):
            words = " ".join(_words(label))
            if words and (name, words) not in NO_LABEL:
                seen.setdefault(words, label)
        rows += [(name, label, words) for words, label in seen.items()]
    rows.sort(key=lambda r: -len(r[2].split()))
    out = [(i, f, label, words, len(words.split()), PARTY_LABELS.get(words)) for i, (f, label, words) in enumerate(rows)]
    return out + [(len(out) + i, None, words, words, len(words.split()), what) for i, (words, what) in enumerate(PARTY_LABELS.items())]


def _words(s: str) -> list[str]:
    s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
    return re.findall(r"[a-z0-9]+", s.lower())


def _last_at(words: Column, word: str, at: Column) -> Column:
    """Place of the last such word at or before a place; -1 where there is none."""
    before = F.slice(words, 1, at + 1)
    return F.coalesce(F.size(before) - F.nullif(F.array_position(F.reverse(before), word), F.lit(0)), F.lit(-1)).cast("int")


def party_at(section: Column, words: Column, at: Column, party_label: Column) -> Column:
    """The party that a label at a place belongs to: the nearest heading before it, else the line's section.

    A party label before the line's first recipient heading, on a recipient line, is the provider's.
    """
    p, r = _last_at(words, "prestador", at), _last_at(words, "tomador", at)
    first = F.array_position(words, "tomador").cast("int") - 1
    by = lambda x: F.when(x["p"] > x["r"], "provider").when(x["r"] > x["p"], "recipient").when((section == "recipient") & (first > at) & party_label, "provider").otherwise(section)
    return F.when(section.isin("provider", "recipient"), let(F.struct(p.alias("p"), r.alias("r")), by)).otherwise(section)


def label_hits(lines: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """lines with labels: array of (field, label, stop, n) - one a field, by the word where the label ends.

    stop counts the elements (words) of the line. Words are looked up by the first word of a label, so no line meets
    every label, and the elements are taken apart only where one stands; of a label's places the first counts. A field keeps the label that ends last; service texts the
    longest label, then the one that ends first.
    """
    by_first: dict[str, list[Column]] = {}
    for rank, name, label, words, n, what in label_table(config):
        entry = F.struct(F.lit(rank).alias("rank"), F.lit(name).cast("string").alias("field"), F.lit(label).alias("label"), F.lit(words).alias("words"), F.lit(n).alias("n"), F.lit(what).cast("string").alias("what"))
        by_first.setdefault(words.split()[0], []).append(entry)
    table = F.create_map(*[y for w, xs in by_first.items() for y in (F.lit(w), F.array(*xs))])
    entry_type = "array<struct<rank:int,field:string,label:string,words:string,n:int,what:string>>"
    normal = F.col("normal") if "normal" in lines.columns else norm(F.col("text"))
    df = lines.withColumn("_w", tokens(normal))
    begins = F.filter(F.transform("_w", lambda t, i: F.struct(t.alias("t"), i.alias("i"))), lambda x: x["t"].isin(list(by_first)))
    fits = lambda t, i: F.filter(F.coalesce(F.try_element_at(table, t), F.array().cast(entry_type)), lambda x: F.array_join(F.slice(F.col("_w"), i + 1, x["n"]), " ") == x["words"])
    df = df.withColumn("_h", F.flatten(F.transform(begins, lambda b: F.transform(fits(b["t"], b["i"]), lambda x: F.struct(x["rank"].alias("rank"), b["i"].alias("at"), x.alias("x"))))))
    at = F.flatten(F.transform("words", lambda w, i: F.transform(tokens(norm(w["text"])), lambda t: i)))
    df = df.withColumn("_t", F.when(F.size("_h") > 0, at))
    df = df.withColumn("_k", F.transform("_h", lambda h: h["rank"]))
    df = df.withColumn("_h", F.array_sort(F.filter("_h", lambda h, i: F.array_position(F.col("_k"), h["rank"]) == i + 1)))

    def scoped(h: Column) -> Column:
        party = party_at(F.col("section"), F.col("_w"), h["at"], h["x"]["what"].isNotNull())
        own = F.when(h["x"]["what"].isNotNull(), let(party, lambda p: F.when(p.isin("provider", "recipient"), F.concat(p, F.lit("_"), h["x"]["what"]))))
        stop = F.element_at("_t", h["at"] + h["x"]["n"])
        return F.struct(F.coalesce(own, h["x"]["field"]).alias("field"), h["x"]["label"].alias("label"), stop.cast("int").alias("stop"), h["x"]["n"].alias("n"), h["rank"].alias("rank"))

    df = df.withColumn("_m", F.filter(F.transform("_h", scoped), lambda m: m["field"].isNotNull()))

    def best(f: Column) -> Column:
        mine = F.filter("_m", lambda m: m["field"] == f)
        text = f.isin(SERVICE_TEXTS)
        order = lambda m: F.struct(F.when(text, m["n"]).otherwise(m["stop"]).alias("a"), F.when(text, -m["stop"]).otherwise(F.lit(0)).alias("b"), (-m["rank"]).alias("c"), m.alias("m"))
        top = F.array_max(F.transform(mine, order))["m"]
        return F.struct(top["stop"].alias("stop"), F.array_min(F.transform(mine, lambda m: m["rank"])).alias("first"), f.alias("field"), top["label"].alias("label"), top["n"].alias("n"))

    fields = F.array_distinct(F.transform("_m", lambda m: m["field"]))
    return df.withColumn("labels", F.array_sort(F.transform(fields, best))).drop("_t", "_w", "_h", "_k", "_m")


def labelled(lines: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Classified lines with their labels, normal text and columns of value tables."""
    return label_hits(fintable.next_of(lines), config)


def prepared(lines: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Classified or labelled lines with the next six lines and mapped value tables. What a step wants of a next line's text it works out itself: few lines need it."""
    df = lines if "labels" in lines.columns else labelled(lines, config)
    return fintable.tables(with_next(df, 6, ["line_index", "section", "normal", "text", "words", "has_columns"]))


def near_code_of(text: Column, normal: Column) -> Column:
    """The service code of a line that tells of one or begins with it."""

    def told(code: Column) -> Column:
        begins = F.regexp_replace(text, r"^[ (]+", "").startswith(code)
        return F.when(code.isNotNull() & (X.says(normal, X.CODE_CONTEXT) | begins & (code.contains(".") | ~text.rlike(X.MONEY) & (F.length(code) == 4) & (F.size(tokens(normal)) >= 4))), code)

    return let(X.service_code(text), told)


def described(next_lines: Column, header: Column) -> Column:
    """(text, places) of the service description after a header line: up to three of the next six lines.

    Lines end at another section or an amount; what stands before a first amount is taken if it reads like prose.
    Headings, lines that begin with a stop word and lines of less than three words are passed over.
    """
    part = "array<struct<text:string,place:int>>"
    start = F.struct(F.lit(False).alias("done"), F.array().cast(part).alias("parts"))

    def step(acc: Column, i: Column) -> Column:
        over = lambda x: F.when(acc["done"] | (x["section"] != "service"), F.struct(F.lit(True).alias("done"), acc["parts"].alias("parts")))
        return let(F.get(next_lines, i), lambda x: over(x).otherwise(let(F.struct(tokens(x["normal"]).alias("toks"), x["text"].rlike(X.MONEY).alias("money")), lambda y: further(acc, i, x, y["toks"], y["money"]))))

    def further(acc: Column, i: Column, x: Column, toks: Column, money: Column) -> Column:
        over = x["normal"].isin(X.HEADINGS) | (F.size(toks) < 3) | F.get(toks, F.lit(0)).isin(X.DESCRIPTION_STOPS)
        prefix = F.split(x["text"], X.MONEY, 2)[0]
        prose = let(tokens(norm(prefix)), lambda ptoks: ~F.exists(ptoks, lambda w: w.isin(X.DESCRIPTION_STOPS)) & (F.size(F.filter(ptoks, lambda w: w.rlike("^[a-z]{3,}$"))) >= 2))
        take = ~over & (~money | (F.size(acc["parts"]) == 0) & prose)
        more = F.when(take, F.array_append(acc["parts"], F.struct(F.when(money, prefix).otherwise(x["text"]).alias("text"), i.alias("place")))).otherwise(acc["parts"])
        return let(more, lambda parts: F.struct((~over & money | (F.size(parts) >= 3)).alias("done"), parts.alias("parts")))

    places = F.slice(F.array(*map(F.lit, range(6))), 1, F.size(next_lines))
    got = F.aggregate(places, start, step)["parts"]
    heads = X.says(header, ["descricao", "discriminacao", "servicos prestados"])
    return F.when(heads, let(got, lambda g: F.when(F.size(g) > 0, g)))


def acceptable(name: Column, value: Column) -> Column:
    """No heading; as a description no amount and no financial phrase."""
    return let(norm(value), lambda n: ~n.isin(X.HEADINGS) & ((name != "service_description") | ~value.rlike(X.MONEY) & ~X.says(n, FINANCE_WORDS)))


def from_labels(df: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """One row for each label of a line that gives a value: field_name, value, value_source, used (elements), label_text, boost."""
    rows = df.filter((F.col("section") != "ignored_billing") & (F.size("labels") > 0)).select("*", F.posexplode("labels").alias("at", "label"))
    f, t, nx = F.col("label.field"), F.col("text"), F.col("next")
    rows = rows.filter(~f.isin(SERVICE_ONLY) | F.col("section").isin("service", "values"))
    # what stands after the label: up to the next label's end, or the first element that begins with a stop word
    after = F.get("labels", F.col("at") + 1)["stop"]
    stop = F.when(after > F.col("label.stop"), after).otherwise(F.size("words"))
    rows = rows.withColumn("_seg", F.slice("words", F.col("label.stop") + 2, F.greatest(stop - F.col("label.stop") - 1, F.lit(0))))
    rows = rows.withColumn("_first", F.transform("_seg", lambda w: F.get(tokens(norm(w["text"])), F.lit(0))))
    end = F.array_position(F.transform("_first", lambda w: F.coalesce(w.isin(STOPS), F.lit(False))), True).cast("int")
    most = F.when(~f.isin("operation_nature", "service_description") & (end > 0), end - 1).otherwise(F.size("_seg"))
    rows = rows.withColumn("_own", F.filter("_seg", lambda w, i: (i < most) & F.get("_first", i).isNotNull()))
    rows = rows.withColumn("raw_value", X.cleaned(F.array_join(F.transform("_own", lambda w: w["text"]), " ")))
    money = f.isin([*config.money_fields, "iss_rate"])
    rows = rows.withColumn("v1", X.typed(f, F.col("raw_value"), config).alias("v1"))
    rows = rows.withColumn("v1", F.when(f.isin(FREE_TEXT), F.nullif("raw_value", F.lit(""))).otherwise(F.col("v1")))
    rows = rows.withColumn("v2", F.when(F.col("v1").isNull() & f.endswith("_email"), X.repaired_email(F.col("raw_value"))))
    # within the whole line
    inline = (
        F.when(f.endswith("_uf"), X.inline_state(t)).when(f.isin("provider_name", "recipient_name"), X.inline_party_name(t)).when(f == "nfse_number", X.typed(F.lit("nfse_number"), t, config))
        .when(f == "service_description", X.typed(f, t, config)).when(f == "verification_code", X.verification_code(F.regexp_replace(t, X.DATE, "")))
    )
    rows = rows.withColumn("v3", F.when(F.coalesce("v1", "v2").isNull(), inline))
    # a code over the next three, two or one lines
    joined = lambda k: F.when(F.size(nx) >= k, X.verification_code(F.array_join(F.transform(F.slice(nx, 1, k), lambda x: x["text"]), " ")))
    rows = rows.withColumn("_coded", F.coalesce("v1", "v2", "v3").isNull() & (f == "verification_code"))
    rows = rows.withColumns({f"w{k}": F.when(F.col("_coded"), joined(k)) for k in (3, 2, 1)})
    rows = rows.withColumn("v4", F.coalesce("w3", "w2", "w1"))
    width = F.when(F.col("w3").isNotNull(), 3).when(F.col("w2").isNotNull(), 2).when(F.col("w1").isNotNull(), 1).otherwise(0)
    # the value table of this header, else the k-th value below the k-th label
    in_table = F.filter("mapped", lambda p: p["field"] == f)
    others = F.filter("labels", lambda x: F.when(f == "iss_rate", x["field"] == "iss_rate").otherwise(x["field"].isin(config.money_fields)))
    below = F.get(nx, F.lit(0))
    rows = rows.withColumn("_none", F.coalesce("v1", "v2", "v3", "v4").isNull())
    none = F.col("_none")
    values = F.when(f == "iss_rate", all_matches(below["text"], X.RATE)).otherwise(X.money_values(below["text"]))
    rows = rows.withColumn("_others", F.when(none & money, others))
    others = F.col("_others")
    place = F.array_position(F.transform(others, lambda x: x["field"]), f).cast("int")
    rows = rows.withColumn("_kth", F.when(none & money & (F.size(nx) > 0) & (F.size("mapped") == 0), let(values, lambda v: F.when(F.size(v) >= F.size(others), F.get(v, place - 1)))))
    kth = F.col("_kth")
    bare = (f == "deductions_amount") & ~X.is_zero(kth) & (norm(F.col("label.label")) == "deducoes")
    kth = F.when(~((f == "iss_rate") & ~kth.contains("%")) & ~bare, kth)
    table = F.when(F.size(nx) > 0, F.when(F.size("mapped") > 0, F.get(in_table, F.lit(0))["value"]).otherwise(kth))
    rows = rows.withColumn("v5", F.when(none & money, table))
    rows = rows.withColumn("v6", F.when(none & (f == "nfse_number") & (below["section"] != "ignored_billing"), X.typed(F.lit("nfse_number"), below["text"], config)))

    def near(x: Column) -> Column:
        own = F.when(f == "issue_date", X.typed(F.lit("issue_date"), x["text"], config)).when(f == "verification_code", X.verification_code(x["text"]))
        service = x["section"].isin("service", "values") & ~x["normal"].isin(X.HEADINGS)
        told = F.when(f == "operation_nature", X.typed(F.lit("operation_nature"), x["text"], config)).when(f == "service_code", near_code_of(x["text"], x["normal"]))
        return F.when(x["section"] != "ignored_billing", F.coalesce(own, F.when(service, told)))

    rows = rows.withColumn("_found", F.when(none & f.isin(NEARBY), F.transform(F.slice(nx, 1, 4), near)))
    rows = rows.withColumn("_near", F.array_position(F.transform("_found", lambda v: v.isNotNull()), True).cast("int"))
    rows = rows.withColumn("v7", F.get("_found", F.col("_near") - 1))
    rows = rows.withColumn("_desc", F.when(f == "service_description", described(nx, F.col("normal"))))
    text = X.typed(F.lit("service_description"), F.array_join(F.transform("_desc", lambda x: x["text"]), " "), config)
    rows = rows.withColumn("_text", F.when(F.col("_desc").isNotNull(), text))
    rows = rows.withColumn("v9", F.when(acceptable(F.lit("service_description"), F.col("_text")), F.col("_text")))
    # a net amount that belongs to another label
    rows = rows.withColumn("_head", F.when(f == "net_amount", F.split(t, r"(?iu)\bvalor\s+l[ií]quido\b", 2)))
    head = F.col("_head")
    rows = rows.withColumn("_value", F.coalesce("v1", "v2", "v3", "v4", "v5", "v6", "v7"))
    credit = (F.size(head) == 2) & (norm(F.get(head, F.lit(1))).startswith("do credito") | X.is_zero(F.col("_value")))
    earlier = F.try_element_at(F.filter(X.money_values(F.get(head, F.lit(0))), lambda v: ~X.is_zero(v)), F.lit(-1))
    rows = rows.withColumn("_value", F.when((f == "net_amount") & credit, F.coalesce(earlier, F.col("_value"))).otherwise(F.col("_value")))
    rows = rows.withColumn("_good", F.col("_value").isNotNull() & acceptable(f, F.col("_value")))
    good = F.col("_good")
    after_header = ~good & (f == "service_description") & F.col("v9").isNotNull()
    source = (
        F.when(after_header, "following_service_lines").when(F.col("v1").isNotNull(), "same_line").when(F.col("v2").isNotNull(), "ocr_corrected_email").when(F.col("v3").isNotNull(), "same_line")
        .when(F.col("v4").isNotNull(), "nearby_lines").when(F.col("v5").isNotNull(), "next_line_table").when(F.col("v6").isNotNull(), "next_line").otherwise("nearby_line")
    )
    rows = rows.withColumn("value_source", source)
    words = lambda a: F.flatten(F.transform(a, lambda x: x["words"]))
    used = (
        F.when(F.col("value_source") == "following_service_lines", F.flatten(F.transform("_desc", lambda x: F.get(nx, x["place"])["words"])))
        .when(F.col("value_source") == "nearby_lines", words(F.slice(nx, 1, width))).when(F.col("value_source").isin("next_line_table", "next_line"), words(F.slice(nx, 1, 1)))
        .when(F.col("value_source") == "nearby_line", F.get(nx, F.col("_near") - 1)["words"]).otherwise(F.col("_own"))
    )
    rows = kept(rows, good | after_header)
    out = rows.withColumn("value", F.when(F.col("value_source") == "following_service_lines", F.col("v9")).otherwise(F.col("_value")))
    return _row(out, f, "label.label", used, 0.08, 0, F.col("at"))


def _row(df: DataFrame, name: Column, label: str | Column, used: Column, boost: float, turn: int, at: Column) -> DataFrame:
    """The columns of a candidate; candidate_ordinal is the order in which candidates arise."""
    order = (F.lit(turn).cast("long") * (1 << 52)) + F.col("line_index").cast("long") * (1 << 16) + at
    return df.select(
        *KEY, order.alias("candidate_ordinal"), name.alias("field_name"), "value", used.alias("used"), F.col(label).alias("label_text") if isinstance(label, str) else label.alias("label_text"), F.lit(boost).alias("boost"),
        "value_source", "text", "line_index", "page_number", "block_num", "bounding_box", "section", "section_confidence", "section_reasons",
    )


def from_patterns(df: DataFrame) -> DataFrame:
    """Candidates without a label: identity numbers, dates of issue, mailboxes and service codes by their form and context."""
    df = df.filter("section <> 'ignored_billing'").withColumn("value_source", F.lit("regex"))
    n, t, s = F.col("normal"), F.col("text"), F.col("section")
    parts = F.split(t, X.DOCUMENT, -1)
    ids = df.select("*", F.posexplode(all_matches(t, X.DOCUMENT)).alias("no", "found"))
    piece = F.array_join(F.transform(F.slice(parts, 1, F.col("no") + 1), lambda x, i: F.concat(F.when(i > 0, F.get(all_matches(t, X.DOCUMENT), i - 1)).otherwise(F.lit("")), x)), "")
    ids = ids.withColumn("_before", norm(piece)).withColumn("_after", norm(F.substring(t, F.length(piece) + F.length("found") + 1, F.length(t))))
    party = s.isin("provider", "recipient")
    context = n.contains("cnpj") | n.contains("cpf") | party & ~F.col("found").rlike(r"^\d+$") & X.says(n, ["insc", "inscricao", "municipal", "razao", "social"])
    phone = F.col("found").rlike(r"^\d{11}$") & X.says(F.col("_before"), ["telefone", "fone", "celular"])
    has = lambda c, w: F.concat(F.lit(" "), c, F.lit(" ")).contains(f" {w} ")
    cut_off = (s == "recipient") & has(F.col("_after"), "tomador") & X.says(F.col("_before"), ["cnpj", "cpf"]) & X.says(F.col("_before"), PARTY_WORDS)
    whose = F.when(party, F.when(has(F.col("_before"), "tomador"), "recipient").when(has(F.col("_before"), "prestador"), "provider").when(cut_off, "provider").otherwise(s)).otherwise(s)
    ids = kept(ids, context & ~phone).withColumn("value", document_mask(F.col("found")))
    field = F.when(whose == "recipient", "recipient_document").otherwise("provider_document")
    out = _row(ids, field, F.lit("document pattern"), F.col("words"), 0.03, 0, F.lit(1 << 12) + F.col("no"))

    def every(rows: DataFrame, name: Column, matches: Column, label: str, base: int) -> DataFrame:
        return _row(rows.select("*", F.posexplode(matches).alias("no", "value")), name, F.lit(label), F.col("words"), 0.03, 0, F.lit(base) + F.col("no"))

    out = out.unionByName(every(df.filter(n.contains("emissao")), F.lit("issue_date"), all_matches(t, X.DATE), "date pattern", 1 << 13))
    out = out.unionByName(every(df.filter(party), F.concat(s, F.lit("_email")), all_matches(t, X.EMAIL), "email pattern", (1 << 13) + (1 << 12)))
    codes = df.filter((s == "service") & X.says(n, X.CODE_CONTEXT))
    return out.unionByName(every(codes, F.lit("service_code"), F.array_compact(F.array(X.service_code(t))), "service_code pattern", 1 << 14))


def from_tables(df: DataFrame) -> DataFrame:
    """A candidate for each mapped value of a value table, with the elements of its value lines."""
    df = df.filter((F.col("section") == "values") & (F.size("fin_columns") >= 2))  # no other line heads a table
    rows = kept(df, F.size("mapped") > 0).withColumn("value_source", F.lit("financial_table")).select("*", F.posexplode("mapped").alias("no", "m")).withColumn("value", F.col("m.value"))
    used = F.flatten(F.transform("fin_lines", lambda i: F.get("next", i)["words"]))
    return _row(rows, F.col("m.field"), "m.label", used, 0.10, 1, F.col("no"))


def built(rows: DataFrame) -> DataFrame:
    """Candidates as they are stored: confidence from the elements used, id, section by field, evidence."""
    name, source = F.col("field_name"), F.col("value_source")
    known = F.filter(F.transform("used", lambda w: w["confidence"]), lambda c: c.isNotNull())
    mean = F.aggregate(known, F.lit(0.0), lambda a, c: a + c) / F.nullif(F.size(known), F.lit(0))
    conf = clamp(F.coalesce(mean, F.lit(0.5)) + F.col("boost"))
    conf = F.when(source == "ocr_corrected_email", F.least(conf * 0.75, F.lit(0.7))).otherwise(conf)
    party = F.when(name.startswith("provider_"), "provider").when(name.startswith("recipient_"), "recipient")
    section = F.when(source == "financial_table", F.col("section")).otherwise(F.coalesce(party, F.col("section")))
    return rows.select(
        *KEY, "candidate_ordinal", F.col("candidate_ordinal").alias("cand_id"), C.candidate_id(F.col("document_id"), name, F.col("line_index"), F.size("used"), F.col("value")).alias("candidate_id"), "field_name", "value",
        F.transform("used", lambda w: w["element_id"]).alias("source_element_ids"), F.lit(SOURCE).alias("source_name"), conf.alias("confidence"), "label_text", F.col("text").alias("context_text"),
        section.alias("section_name"), F.col("section").alias("raw_section_name"), (section != F.col("section")).alias("section_override_applied"), "section_confidence", "section_reasons", "page_number",
        F.col("text").alias("line_text"), "line_index", "value_source", (source == "same_line").alias("same_block_as_label"), "block_num", F.col("block_num").alias("label_block_num"), "bounding_box",
        (source == "ocr_corrected_email").alias("ocr_correction_applied"),
    )


def candidates_from_lines(lines: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Every candidate of classified lines, which are written once, with their labels: three ways lead on from them."""
    lines = cut(labelled(lines, config))
    df = prepared(lines, config)
    return built(from_labels(df, config).unionByName(from_patterns(lines)).unionByName(from_tables(df)))


def chosen(found: DataFrame) -> DataFrame:
    """Candidates after duplicates, with one for each singleton field, and their review flags; in order of field and line number as text."""
    found = cut(found)  # used three times
    counts = C.distinct_values(found)
    once = C.deduplicated(found).withColumn("candidate_ordinal", F.col("first_ordinal")).drop("first_ordinal")
    best = C.best_singletons(once).select(*KEY, "field_name", F.col("cand_id").alias("_id"))
    single = F.col("field_name").isin(C.SINGLETONS)
    left = once.join(best, [*KEY, "field_name"], "left").filter(~single | (F.col("cand_id") == F.col("_id"))).drop("_id")
    return C.review_flags(left, counts).orderBy(*KEY, "field_name", F.col("line_index").cast("string"), "candidate_ordinal")


def candidates(elements: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """From elements to chosen candidates."""
    return chosen(candidates_from_lines(classify_sections(build_lines(elements)), config))


