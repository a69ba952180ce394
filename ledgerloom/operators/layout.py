"""Page layout: boxes, tables, rows and cells."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip



def resized(w: Column, h: Column, most: int = 1280, least: int = 28) -> Column:
    """Width and height after the longest side is brought down to most and then the shortest up to least; the other side is truncated."""
    shrink = F.greatest(w, h) > most
    w1 = F.when(shrink, F.when(w >= h, F.lit(most)).otherwise((w * most / h).cast("int"))).otherwise(w.cast("int"))
    h1 = F.when(shrink, F.when(w >= h, (h * most / w).cast("int")).otherwise(F.lit(most))).otherwise(h.cast("int"))
    grow = F.least(w1, h1) < least
    w2 = F.when(grow, F.when(w1 <= h1, F.lit(least)).otherwise((w1 * least / h1).cast("int"))).otherwise(w1)
    h2 = F.when(grow, F.when(w1 <= h1, (h1 * least / w1).cast("int")).otherwise(F.lit(least))).otherwise(h1)
    return F.struct(w2.alias("w"), h2.alias("h"))


#: Fixed value: where a typed value begins within a text of label and value.
TYPED = r"\b\d{2}/\d{2}/\d{4}\b|\b\d{2}/\d{4}\b|\b\d{2}[.,]\d{3}\.\d{3}/\d{4}-\d{2}\b|\b\d{3}\.\d{3}\.\d{3}-\d{2}\b|R\$\s*\d|\b\d{1,3}(?:\.\d{3})+,\d{2}\b|\b\d{5}-\d{3}\b|\b\d{4,}\b"


def typed_split(text: Column) -> Column:
    """A text of label and value as both, cut where a typed value begins; as it is where no letters stand before one."""
    head = F.split(text, TYPED, 2)[0]
    label = strip(head)
    cut = (F.length(head) < F.length(text)) & label.rlike(r"\p{L}")
    return F.when(cut, F.array(label, strip(F.substring(text, F.length(head) + 1, F.length(text))))).otherwise(F.array(text))


def cells_of(row: Column) -> Column:
    """The labels and values of a row: cut at double blanks, each part at its first colon and blank, or where a typed value begins."""
    parts = F.filter(F.split(row, "  "), lambda p: strip(p) != "")
    both = lambda p: F.when(p.contains(": "), F.transform(F.split(p, ": ", 2), strip)).otherwise(typed_split(p))
    return F.filter(F.flatten(F.transform(parts, both)), lambda x: x != "")


def row_elements(df: DataFrame, key: str, text: str, box: str | None = None) -> DataFrame:
    """(key, cell_no, cell, x, w): the cells of a row, each with its share of the row's width by its signs; one cell stays the row."""
    cells = cells_of(F.col(text))
    df = df.select(key, F.when(F.size(cells) > 1, cells).otherwise(F.array(text)).alias("_c"), *([F.col(box).alias("_b")] if box else [F.lit(None).cast("struct<x:double,y:double,w:double,h:double>").alias("_b")]))
    total = F.aggregate(F.transform("_c", F.length), F.lit(0), lambda a, n: a + n)
    before = lambda i: F.aggregate(F.transform(F.slice(F.col("_c"), 1, i), F.length), F.lit(0), lambda a, n: a + n)
    cell = F.transform("_c", lambda c, i: F.struct(c.alias("cell"), (F.col("_b.x") + F.col("_b.w") * before(i) / total).alias("x"), (F.col("_b.w") * F.length(c) / total).alias("w")))
    return df.filter("_c[0] is not null").select(key, F.posexplode(cell).alias("cell_no", "s")).select(key, "cell_no", "s.*")


def layout_items(df: DataFrame, key: str, layout: str) -> DataFrame:
    """(key, item_no, x1, y1, x2, y2, label, tags) of layout strings: parts with four numbers, then bracketed label and tags."""
    number = r"\d*\.?\d+"
    coords = rf"\[({number}),({number}),({number}),({number})\]"
    parts = F.filter(F.transform(F.split(F.col(layout), r"\[PAIR_SEP\]|\[RELATION_SEP\]"), F.trim), lambda p: p.rlike(coords))

    def item(p: Column) -> Column:
        words = F.filter(F.regexp_extract_all(p, F.lit(r"\[([^\]]+)\]"), 1), lambda w: ~w.rlike(rf"^{number},{number},{number},{number}$"))
        at = [F.regexp_extract(p, coords, i).cast("double") for i in range(1, 5)]
        return F.struct(*[c.alias(n) for c, n in zip(at, ("x1", "y1", "x2", "y2"))], F.trim(F.get(words, F.lit(0))).alias("label"), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))).alias("tags"))

    got = F.filter(F.transform(parts, item), lambda x: x["label"].isNotNull())
    return df.select(key, F.posexplode(got).alias("item_no", "i")).select(key, "item_no", "i.*")


def scaled(box: Column, sx: float, sy: float, width: float, height: float) -> Column:
    """Model coordinates to pixels: truncated, clamped to the page, at least one pixel wide and high."""
    x1 = F.least(F.greatest((box.x * sx).cast("int"), F.lit(0)), F.lit(int(width)) - 1)
    y1 = F.least(F.greatest((box.y * sy).cast("int"), F.lit(0)), F.lit(int(height)) - 1)
    x2 = F.greatest(F.least(((box.x + box.w) * sx).cast("int"), F.lit(int(width))), x1 + 1)
    y2 = F.greatest(F.least(((box.y + box.h) * sy).cast("int"), F.lit(int(height))), y1 + 1)
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def union_box(df: DataFrame, keys: list[str]) -> DataFrame:
    b = F.col("bounding_box")
    g = df.groupBy(*keys).agg(F.min(b.x).alias("x"), F.min(b.y).alias("y"), F.max(b.x + b.w).alias("r"), F.max(b.y + b.h).alias("t"))
    return g.select(*keys, "x", "y", (F.col("r") - F.col("x")).alias("w"), (F.col("t") - F.col("y")).alias("h"))


def iou(a: Column, b: Column) -> Column:
    w = F.greatest(F.least(a.x + a.w, b.x + b.w) - F.greatest(a.x, b.x), F.lit(0.0))
    h = F.greatest(F.least(a.y + a.h, b.y + b.h) - F.greatest(a.y, b.y), F.lit(0.0))
    inter = w * h
    total = a.w * a.h + b.w * b.h - inter
    return F.when(total > 0, inter / total).otherwise(0.0)


def overlaps(boxes: DataFrame, keys: list[str], item: str, least: float = 0.1, share: float = 0.25) -> DataFrame:
    """(keys, boxes, overlapping, crowded) of each page: boxes with an overlap above least; is their share above share?

    Boxes that overlap by a share of their union are of like size, within the factor 1 / least. A box lies on the grid
    whose cells are as wide as its longer side rounded up to a power of two, so it covers at most four cells, and meets the
    boxes of its own level and of the few levels below that such an overlap allows.
    """
    b = F.col("bounding_box")
    full = boxes.filter(b.isNotNull() & b.x.isNotNull() & b.y.isNotNull() & b.w.isNotNull() & b.h.isNotNull() & (b.w > 0) & (b.h > 0))
    level = F.ceil(F.log2(F.greatest(b.w, b.h))).cast("int")
    # areas differ by at most 1 / least, sides by at most 1 / least for boxes as thin as they like
    reach = math.ceil(math.log2(1 / least)) + 1
    cells = lambda lo, n, size: F.sequence(F.floor(lo / size), F.floor((lo + n) / size))

    def on(df: DataFrame, grid: Column) -> DataFrame:
        df = df.withColumn("grid", grid).withColumn("size", F.pow(F.lit(2.0), F.col("grid")))
        df = df.withColumn("cx", F.explode(cells(b.x, b.w, F.col("size"))))
        return df.withColumn("cy", F.explode(cells(b.y, b.h, F.col("size")))).select(*keys, item, "bounding_box", "grid", "cx", "cy")

    low = full.withColumn("level", level)
    large = on(low, F.col("level"))
    # a box looks for larger ones on their grids, where it covers at most four cells too
    small = on(low.withColumn("up", F.explode(F.sequence(F.col("level"), F.col("level") + reach))), F.col("up"))
    right = large.select(*keys, F.col(item).alias("other"), F.col("bounding_box").alias("q"), "grid", "cx", "cy")
    left = small.select(*keys, F.col(item).alias("_i"), F.col("bounding_box").alias("p"), "grid", "cx", "cy")
    size = F.pow(F.lit(2.0), F.col("grid"))
    corner = (F.floor(F.greatest(F.col("p.x"), F.col("q.x")) / size) == F.col("cx")) & (F.floor(F.greatest(F.col("p.y"), F.col("q.y")) / size) == F.col("cy"))
    pairs = left.join(right, [*keys, "grid", "cx", "cy"]).filter((F.col("_i") != F.col("other")) & corner & (iou(F.col("p"), F.col("q")) > least))
    hit = pairs.select(*keys, F.explode(F.array("_i", "other")).alias(item)).distinct()
    n = boxes.filter(b.isNotNull() & b.x.isNotNull() & b.y.isNotNull() & b.w.isNotNull() & b.h.isNotNull()).groupBy(*keys).agg(F.count("*").alias("boxes"))
    m = hit.groupBy(*keys).agg(F.count("*").alias("overlapping"))
    out = n.join(m, keys, "left").withColumn("overlapping", F.coalesce("overlapping", F.lit(0)))
    return out.withColumn("crowded", F.col("overlapping") / F.col("boxes") > share)


def table_rows(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, row_no, row_text, n_cells): one row for each table row; cells without tags, joined by two blanks."""
    rows = df.select(key, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)).alias("row_no", "row"))
    cells = F.regexp_extract_all(F.col("row"), F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), 1)
    clean = F.filter(F.transform(cells, lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), r"\s+", " "))), lambda c: c != "")
    return rows.select(key, "row_no", F.array_join(clean, "  ").alias("row_text"), F.size(clean).alias("n_cells"))


def table_elements(df: DataFrame, key: str, html: str, order: str = "ordinal") -> DataFrame:
    """(key, reading_order, text, y, h): the rows of a table as elements below each other, or the element itself where it has none.

    A row has its share of the table's height and comes at order * 1000 + its number; rows without text are dropped.
    """
    found = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)
    cells = lambda r: F.filter(F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), 1), lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"\s+", " "))), lambda c: c != "")
    b, n, o = F.col("bounding_box"), F.size(found), F.col(order).cast("long")
    row = lambda r, i: F.struct((o * 1000 + i).alias("reading_order"), F.array_join(cells(r), "  ").alias("text"), (b.y + i * b.h / n).alias("y"), (b.h / n).alias("h"))
    rows = F.filter(F.transform(found, row), lambda x: x["text"] != "")
    whole = F.array(F.struct(o.alias("reading_order"), F.col(html).alias("text"), b.y.alias("y"), b.h.alias("h")))
    return df.select(key, F.explode(F.when(F.size(rows) > 0, rows).otherwise(whole)).alias("e")).select(key, "e.*")


def row_pieces(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, piece_no, piece, x_share): a row cut at double blanks; x_share is the part of its signs before the piece."""
    parts = F.filter(F.split(F.col(text), r"  +"), lambda p: F.trim(p) != "")
    cut = df.select(key, F.posexplode(parts).alias("piece_no", "piece")).filter("piece is not null")
    w = Window.partitionBy(key)
    before = F.coalesce(F.sum(F.length("piece")).over(w.orderBy("piece_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum(F.length("piece")).over(w)
    return cut.withColumn("x_share", before / total)


def sequence_confidence(df: DataFrame, keys: list[str], p: str, prior: float = 0.92) -> DataFrame:
    """(keys, confidence): the geometric mean of probabilities, 0 to 1; prior where there is none."""
    return df.groupBy(*keys).agg(F.coalesce(F.least(F.exp(F.avg(F.when(F.col(p) > 0, F.ln(p)))), F.lit(1.0)), F.lit(prior)).alias("confidence"))
