"""Value tables: a header line of money and rate columns, and the values on the lines after it.

Columns, values and their alignment are arrays worked on by higher-order functions; nothing is multiplied
until the mapped values are exploded.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.extract import HEADINGS, is_zero, says
from ..functions.text import let, norm

# Labels of columns; a column without a field holds a place.
LABELS = [
    ("gross_amount", "valor total dos servicos"), ("gross_amount", "valor total do servico"), ("gross_amount", "valor total da nota"), ("gross_amount", "valor bruto da nota"), ("gross_amount", "valor total"), ("gross_amount", "prestado valor"),
    ("deductions_amount", "valor total das deducoes"),
    ("unconditional_discount", "desconto incondicionado"), ("unconditional_discount", "desconto incondicional"), ("unconditional_discount", "desc incondicionado"), ("unconditional_discount", "desc incondic"),
    ("conditional_discount", "desconto condicionado"), ("conditional_discount", "desconto condicional"), ("conditional_discount", "desc condicionado"),
    ("other_retentions_amount", "outras retencoes"),
    (None, "valor retencoes"), (None, "total trib federais"), (None, "total trib"), (None, "valor do credito"), (None, "desconto"),
    ("taxable_amount", "base de calculo do issqn"), ("taxable_amount", "base de calculo issqn"), ("taxable_amount", "base calculo iss"), ("taxable_amount", "base de calculo"), ("taxable_amount", "base calculo"),
    ("iss_rate", "aliquota do issqn"), ("iss_rate", "aliquota issqn"), ("iss_rate", "aliquota iss"), ("iss_rate", "aliquota"), ("iss_rate", "alig"), ("iss_rate", "aliq"),
    ("iss_amount", "issqn devido"), ("iss_amount", "valor do iss"), ("iss_amount", "valor iss"),
    ("net_amount", "valor liquido da nota"), ("net_amount", "valor liquido"),
    ("pis_withheld_amount", "pis pasep"), ("pis_withheld_amount", "pis"), ("cofins_withheld_amount", "cofins"), ("inss_withheld_amount", "inss"), ("ir_withheld_amount", "irrf"), ("ir_withheld_amount", "ir"), ("csll_withheld_amount", "csll"),
    ("deductions_amount", "valor deducao"), ("deductions_amount", "deducoes"), ("deductions_amount", "deducao"),
    ("gross_amount", "valor servico"),
]
# Phrases of lines that only inform; forms of values.
INFORMS = ["disp ret", "igual ou menor", "lei ", "lei complementar", "pgto", "transparencia", "valor aproximado"]
VALUE = r"(?:R\$\s*-?\s*)?\d{1,3}(?:\.\d{3})*,\d{2,4}\s*%?|(?:R\$\s*-?\s*)?\d+,\d{2,4}\s*%?|\d{1,2}\s*%"
FRAGMENT = r"^\s*,\s*\d{2}\s*$"
HIT = "array<struct<field:string,label:string,start:int,stop:int>>"


def columns_of(normal: Column, specs: list[tuple[str | None, str]] = LABELS) -> Column:
    """Array of (field, label, start, stop) of the column labels in a normal text, in order; longer labels are placed first.

    start and stop are word numbers. Words are looked up by the first word of a label; placed words are taken.
    """
    ranked = sorted(specs, key=lambda x: -len(x[1]))
    by_first: dict[str, list[Column]] = {}
    for i, (name, label) in enumerate(ranked):
        by_first.setdefault(label.split()[0], []).append(F.struct(F.lit(i).alias("rank"), F.lit(name).cast("string").alias("field"), F.lit(label).alias("label"), F.lit(len(label.split())).alias("n")))
    table = F.create_map(*[y for w, xs in by_first.items() for y in (F.lit(w), F.array(*xs))])

    def hits_of(words: Column) -> Column:
        def at(b: Column) -> Column:
            fits = F.filter(F.coalesce(F.try_element_at(table, b["word"]), F.array().cast("array<struct<rank:int,field:string,label:string,n:int>>")), lambda x: F.array_join(F.slice(words, b["i"] + 1, x["n"]), " ") == x["label"])
            return F.transform(fits, lambda x: F.struct(x["rank"].alias("rank"), b["i"].alias("start"), (b["i"] + x["n"]).alias("stop"), x["field"].alias("field"), x["label"].alias("label")))

        begins = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("i"))), lambda b: b["word"].isin(list(by_first)))
        return F.flatten(F.transform(begins, at))

    hits = F.array_sort(let(F.split(normal, " "), hits_of))
    free = lambda acc, h: ~F.exists(acc, lambda a: (a["start"] < h["stop"]) & (h["start"] < a["stop"]))
    one = lambda h: F.struct(h["start"].alias("start"), h["stop"].alias("stop"), h["field"].alias("field"), h["label"].alias("label"))
    placed = F.aggregate(hits, F.array().cast("array<struct<start:int,stop:int,field:string,label:string>>"), lambda acc, h: F.when(free(acc, h), F.array_append(acc, one(h))).otherwise(acc))
    return F.transform(F.array_sort(placed), lambda x: F.struct(x["field"].alias("field"), x["label"].alias("label"), x["start"].alias("start"), x["stop"].alias("stop")))


def is_table(normal: Column, columns: Column) -> Column:
    """Two columns with a field, or a rate column and another; no line that only informs."""
    real = F.size(F.filter(columns, lambda c: c["field"].isNotNull())) >= 2
    rate = F.exists(columns, lambda c: c["field"].eqNullSafe(F.lit("iss_rate"))) & (F.size(columns) >= 2)
    return ~says(normal, INFORMS) & (real | rate)


def merged(text: Column) -> Column:
    """Numbers that a blank has parted before their comma, put together."""
    return F.regexp_replace(F.regexp_replace(text, r"\b(\d+)\s+,\s*(\d{2,4})\b", "$1,$2"), r"(R\$)\s+(-)\s+", "$1 $2 ")


def values_of(text: Column) -> Column:
    """Array of (value, rate): amounts and shares in order; a share ends with its percent sign."""
    found = F.regexp_extract_all(merged(text), F.lit(VALUE), 0)
    tidy = F.transform(found, lambda v: F.regexp_replace(F.trim(F.regexp_replace(v, r"\s+", " ")), r"\s*%\s*$", "%"))
    return F.transform(tidy, lambda v: F.struct(v.alias("value"), v.endswith("%").alias("rate")))


def value_lines(following: Column) -> Column:
    """How many and which of the next lines hold the values: array of their places among `following`.

    following: array of structs with section, normal, text and has_columns. Lines of values are taken until
    another header, another section or a line without values; two lines, more only while they are split ends of numbers.
    """
    start = F.struct(F.lit(False).alias("done"), F.array().cast("array<int>").alias("taken"))

    def step(acc: Column, i: Column) -> Column:
        x = F.element_at(following, i + 1)
        part = x["text"].rlike(FRAGMENT)
        some = F.size(acc["taken"]) > 0
        has = merged(x["text"]).rlike(VALUE) | part
        stop = acc["done"] | (x["section"] != "values") | (~x["normal"].isin(HEADINGS) & some & (x["has_columns"] | ~has))
        take = ~stop & ~x["normal"].isin(HEADINGS) & has
        taken = F.when(take, F.array_append(acc["taken"], i)).otherwise(acc["taken"])
        return F.struct((stop | take & (F.size(acc["taken"]) >= 1) & ~part).alias("done"), taken.alias("taken"))

    places = F.slice(F.array(F.lit(0), F.lit(1), F.lit(2)), 1, F.least(F.size(following), F.lit(3)))
    return F.aggregate(places, start, step)["taken"]


def _plain_rate(v: Column) -> Column:
    """Can a value without a percent sign be a share?"""
    n = F.replace(F.replace(F.regexp_replace(v, r"[^\d,.\-]", ""), F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")
    return v.endswith("%") | ~F.upper(v).contains("R$") & ~is_zero(v) & F.coalesce((n > 0) & (n <= 100), F.lit(False))


def _accepted(name: Column, v: Column) -> Column:
    return F.when(name == "iss_rate", _plain_rate(v)).when((name == "deductions_amount") & ~is_zero(v), F.lit(False)).otherwise(~v.endswith("%"))


PAIR = "array<struct<field:string,value:string,label:string>>"


def _side(columns: Column, values: Column) -> Column:
    """Array of (field, value, label): the amounts of one side of the table on its columns.

    Enough amounts: in order. Fewer: a single one only on the tax base of at most two columns; else the last on the
    last, and the first on the first if that is a zero deduction, retention or place holder.
    """
    money = F.filter(values, lambda v: ~v["rate"])
    n, m = F.size(columns), F.size(money)
    pair = lambda c, v: F.struct(c["field"].alias("field"), v["value"].alias("value"), c["label"].alias("label"))
    none = F.array().cast(PAIR)
    order = F.transform(columns, lambda c, i: pair(c, F.get(money, i)))
    base = F.filter(columns, lambda c: c["field"].eqNullSafe(F.lit("taxable_amount")))
    single = F.when((F.size(base) > 0) & (n <= 2), F.array(pair(F.get(base, F.lit(0)), F.get(money, F.lit(0))))).otherwise(none)
    head, first = F.get(columns, F.lit(0)), F.get(money, F.lit(0))
    ends = F.array(pair(F.get(columns, n - 1), F.get(money, m - 1)))
    zero = (head["field"].isNull() | head["field"].isin("deductions_amount", "other_retentions_amount")) & is_zero(first["value"])
    sparse = F.when(m == 1, single).otherwise(F.when(zero, F.concat(F.array(pair(head, first)), ends)).otherwise(ends))
    pairs = F.when((n == 0) | (m == 0), none).when(m >= n, order).otherwise(sparse)
    return F.filter(pairs, lambda p: p["field"].isNotNull() & _accepted(p["field"], p["value"]))


def mapped(df: DataFrame, columns: str, values: str, out: str = "mapped") -> DataFrame:
    """df with out: array of (field, value, label), each field once, the values put on the columns around the rate.

    Without a rate all amounts are put on all columns, and a further amount after a tax base is the tax.
    """
    c, v = F.col(columns), F.col(values)
    df = df.withColumn("_r", F.array_position(F.transform(c, lambda x: F.coalesce(x["field"], F.lit(""))), "iss_rate").cast("int"))
    marked = F.array_position(F.transform(v, lambda x: x["rate"]), True).cast("int")
    shape = F.get(v, F.col("_r") - 1)["value"]
    df = df.withColumn("_v", F.when(F.col("_r") > 0, F.when(marked > 0, marked).when(F.coalesce(_plain_rate(shape), F.lit(False)), F.col("_r"))))
    r, k = F.col("_r"), F.col("_v")
    cut = lambda a, lo, n: F.slice(a, lo, F.greatest(n, F.lit(0)))
    df = df.withColumn("_left", F.when(k.isNotNull(), _side(cut(c, 1, r - 1), cut(v, 1, k - 1))).otherwise(_side(c, v)))
    df = df.withColumn("_after", F.when(k.isNotNull(), cut(v, k + 1, F.size(v) - k)))
    df = df.withColumn("_right", F.when(k.isNotNull(), _side(cut(c, r + 1, F.size(c) - r), F.col("_after"))))
    rate = F.get(v, k - 1)["value"]
    pair = lambda f, x, label: F.struct(F.lit(f).alias("field"), x.alias("value"), label.alias("label"))
    none = F.array().cast(PAIR)
    mid = F.when(F.coalesce(_plain_rate(rate), F.lit(False)), F.array(pair("iss_rate", rate, F.get(c, r - 1)["label"]))).otherwise(none)
    every = F.concat(F.col("_left"), F.when(k.isNotNull(), mid).otherwise(none), F.coalesce("_right", none))
    df = df.withColumn("_all", every)
    has_tax = F.exists("_all", lambda p: p["field"] == "iss_amount")
    money = F.filter(v, lambda x: ~x["rate"])
    tax = F.when(k.isNotNull(), F.get(F.filter("_after", lambda x: ~x["rate"]), F.lit(0))["value"]).when(F.exists(c, lambda x: x["field"].eqNullSafe(F.lit("taxable_amount"))) & (F.size(money) > F.size(c)), F.get(money, F.size(money) - 1)["value"])
    df = df.withColumn("_all", F.when(~has_tax & tax.isNotNull(), F.concat("_all", F.array(pair("iss_amount", tax, F.lit("valor iss"))))).otherwise(F.col("_all")))
    names = F.transform("_all", lambda p: p["field"])
    first = F.filter("_all", lambda p, i: F.array_position(names, p["field"]) == i + 1)
    return df.withColumn(out, first).drop("_r", "_v", "_left", "_after", "_right", "_all")


def tables(lines: DataFrame) -> DataFrame:
    """lines (with section, normal, next) with fin_columns, fin_lines (places of the value lines) and mapped.

    next: the following lines with section, normal, text and has_columns. Lines that head no table have empty arrays.
    """
    none = F.array().cast("array<int>")
    df = lines if "fin_columns" in lines.columns else lines.withColumn("fin_columns", columns_of(F.col("normal")))
    heads = (F.col("section") == "values") & is_table(F.col("normal"), F.col("fin_columns"))
    df = df.withColumn("fin_lines", F.when(heads, value_lines(F.col("next"))).otherwise(none))
    text = F.array_join(F.transform("fin_lines", lambda i: F.get("next", i)["text"]), " ")
    df = df.withColumn("fin_values", F.when(F.size("fin_lines") > 0, values_of(text)).otherwise(F.array().cast("array<struct<value:string,rate:boolean>>")))
    df = mapped(df, "fin_columns", "fin_values", "mapped")
    return df.withColumn("mapped", F.when(F.size("fin_values") > 0, F.col("mapped")).otherwise(F.array().cast(PAIR)))


def next_of(df: DataFrame) -> DataFrame:
    """Normal text and column flag of lines, as with_next needs them."""
    df = df if "normal" in df.columns else df.withColumn("normal", norm(F.col("text")))
    df = df.withColumn("fin_columns", F.when(F.col("section") == "values", columns_of(F.col("normal"))).otherwise(F.array().cast(HIT)))
    return df.withColumn("has_columns", F.size("fin_columns") > 0)


