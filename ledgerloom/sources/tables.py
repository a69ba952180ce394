"""Readers: tables with redelivered rows, files, OCR payloads, caches."""

from __future__ import annotations

import glob
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dictionary import MEDIA_TYPES
from ..functions.values import uuid5


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def latest(df: DataFrame, key: str, at: str = "loaded_at", columns: list[str] | None = None) -> DataFrame:
    """The latest delivery of every key: only the wanted columns are read and aggregated (before the shuffle already).

    What is wanted is said here, as the optimizer cannot prune within an aggregate of structs. A null time is the earliest.
    """
    cols = [c for c in (columns or df.columns) if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*cols), F.coalesce(F.col(at).cast("timestamp"), F.timestamp_micros(F.lit(0)))).alias("r")).select(key, "r.*")


def elements(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The latest delivery of every element; all columns if none is named."""
    return latest(table(spark, sf, "raw_artifacts"), "artifact_id", columns=list(columns) or None)


def candidates(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The latest delivery of every candidate; all columns if none is named."""
    return latest(table(spark, sf, "candidates"), "cand_id", columns=list(columns) or None)


def suffix(c: Column) -> Column:
    return F.lower(F.nullif(F.regexp_extract(c, r"\.([A-Za-z0-9]+)$", 1), F.lit("")))


def media_type(explicit: Column, name: Column) -> Column:
    """The stated media type, else the one of the file name's suffix, else null."""
    known = F.create_map(*[F.lit(x) for p in MEDIA_TYPES.items() for x in p])
    return F.coalesce(F.nullif(F.trim(explicit), F.lit("")), F.try_element_at(known, suffix(name)))


def uri_path(c: Column) -> Column:
    """The path of a file URI (percent signs decoded, the host of a network share before it) or of a plain path; null for other schemes."""
    scheme = F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    host = F.regexp_extract(c, r"^[Ff][Ii][Ll][Ee]://([^/]*)", 1)
    path = F.regexp_replace(c, r"^[Ff][Ii][Ll][Ee]:(?://[^/]*)?", "")
    share = F.when(~F.lower(host).isin("", "localhost"), F.concat(F.lit("//"), host)).otherwise("")
    return F.when(F.lower(scheme) == "file", F.concat(share, F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))))).when(scheme == "", c)


def file_uri(path: Column) -> Column:
    """The file URI of an absolute path, percent-encoded as in a URI (blanks as %20, slashes kept)."""
    coded = F.regexp_replace(F.url_encode(path), r"\+", "%20")
    for sign, code in (("/", "%2F"), ("~", "%7E"), ("*", "\\*")):
        coded = F.regexp_replace(coded, code, sign)
    return F.concat(F.lit("file://"), F.replace(coded, F.lit("*"), F.lit("%2A")))


KNOWN = ("pdf", "png", "jpg", "jpeg", "tif", "tiff")


def path_list(text: str) -> list[str]:
    """Paths of a comma-separated list, blanks off, in order; an empty list is an error."""
    paths = [p.strip() for p in text.split(",") if p.strip()]
    if not paths:
        raise ValueError("no path is given")
    return paths


def found_files(pattern: str, most: int | None = None) -> list[str]:
    """Files that match a pattern, sorted, at most so many."""
    return sorted(glob.glob(pattern))[:most]


def load_files(spark: SparkSession, paths: list[str], missing: str = "error") -> DataFrame:
    """Documents of files in input order, duplicates kept; content is read when it is used.

    A path that is not there, is no file or has another suffix is an error; missing="skip" leaves such paths out (an
    error if none is left); missing="row" keeps them as rows with an error and without content.
    """
    def fault(p: str) -> str | None:
        if "://" in p:
            return None  # remote stores tell when they are read
        if not os.path.exists(p):
            return "missing"
        if not os.path.isfile(p):
            return "not a file"
        return None if p.rsplit(".", 1)[-1].lower() in KNOWN else "unknown suffix"

    faults = {p: fault(p) for p in dict.fromkeys(paths)}
    bad = {p: f for p, f in faults.items() if f}
    if bad and missing == "error":
        raise ValueError("; ".join(f"{p}: {f}" for p, f in bad.items()))
    kept = paths if missing == "row" else [p for p in paths if p not in bad]
    good = [p for p in dict.fromkeys(kept) if p not in bad]
    if not kept or missing == "skip" and not good:
        raise ValueError("no file is left")
    order = spark.createDataFrame([(i, p, bad.get(p)) for i, p in enumerate(kept)], "sample_index int, path string, error string")
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.read.format("binaryFile").load(good) if good else spark.createDataFrame([], schema)
    files = files.select(F.regexp_replace("path", "^file:(?://)?", "").alias("path"), "length", "content")
    out = order.join(files, "path", "left").withColumn("source_uri", file_uri(F.col("path")))
    return out.select(uuid5(F.col("source_uri")).alias("document_id"), "source_uri", media_type(F.lit(None).cast("string"), F.col("path")).alias("media_type"), F.col("length").alias("file_size_bytes"), suffix(F.col("path")).alias("file_extension"), "sample_index", "content", "error")


def read_through(docs: DataFrame, cached: DataFrame, extract: Callable[[DataFrame], DataFrame], key: str = "document_id") -> DataFrame:
    """Cached rows of the documents, and what `extract` makes of those that the cache lacks."""
    misses = cache_misses(docs, cached, key)
    return cached.join(docs.select(key).distinct(), key, "left_semi").unionByName(extract(misses))


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of JSON array files; a record that does not fit the schema is an error."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def column_pages(pages: DataFrame) -> DataFrame:
    """Pages of parallel arrays (text, conf, left, top, width, height) to element rows.

    Blank texts are dropped, but keep their place in the numbering; a confidence below 0 is null, else of 100.
    """
    z = F.arrays_zip("text", "conf", "left", "top", "width", "height")
    rows = pages.select("document_id", "page_number", F.posexplode(z).alias("i", "e"))
    box = F.when(F.col("e.left").isNotNull() & F.col("e.top").isNotNull() & F.col("e.width").isNotNull() & F.col("e.height").isNotNull(), F.struct(F.col("e.left").alias("x"), F.col("e.top").alias("y"), F.col("e.width").alias("w"), F.col("e.height").alias("h")))
    kept = rows.filter(F.col("e.text").rlike(r"(?U)\S"))
    return kept.select("document_id", "page_number", F.col("i").alias("ordinal"), F.concat_ws(":", "document_id", F.lit("columns"), "i").alias("element_id"), F.trim("e.text").alias("text"), F.when(F.col("e.conf") >= 0, F.col("e.conf") / 100).alias("confidence"), box.alias("bounding_box"))


WRAPPERS = ("elements", "predictions", "tokens", "items")


def payload_items(payloads: DataFrame, payload: str = "payload", depth: int = 3) -> DataFrame:
    """(other columns, item_no, item): the objects of a payload in JSON.

    A text is one item with that text; of a list, objects and texts count, other members are dropped; an object with a list
    under one of WRAPPERS is that list (also within each other, to the depth given); another object is one item.
    Anything else is an error.
    """
    keep = [c for c in payloads.columns if c != payload]
    v = F.try_parse_json(F.col(payload))
    for _ in range(depth):
        inner = F.coalesce(*[F.try_variant_get(v, f"$.{w}", "array<variant>") for w in WRAPPERS])
        v = F.when(inner.isNotNull(), F.to_variant_object(inner)).otherwise(v)
    kind = F.schema_of_variant(v)
    many = F.try_variant_get(v, "$", "array<variant>")
    text = lambda x: F.to_json(F.struct(F.try_variant_get(x, "$", "string").alias("text")))
    item = lambda x: F.when(F.schema_of_variant(x).startswith("OBJECT"), F.to_json(x)).when(F.schema_of_variant(x) == "STRING", text(x))
    plain = F.when(kind.startswith("OBJECT"), F.array(F.to_json(v))).when(kind == "STRING", F.array(text(v)))
    items = F.when(kind.startswith("ARRAY"), F.filter(F.transform(many, item), lambda x: x.isNotNull())).otherwise(plain)
    sure = F.when(F.col(payload).isNull(), F.array().cast("array<string>")).otherwise(F.coalesce(items, F.raise_error(F.concat(F.lit("unknown form of a payload: "), F.coalesce(kind, F.lit("no JSON"))))))
    return payloads.select(*keep, F.posexplode(sure).alias("item_no", "item"))


def json_elements(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Element columns of a JSON object whose keys vary; one VARIANT is parsed a row. A box counts if it has four numbers."""
    v = F.try_parse_json(F.col(payload))
    get = lambda *paths, t: F.coalesce(*[F.try_variant_get(v, f"$.{p}", t) for p in paths])
    conf = get("confidence", "score", "probability", t="double")
    boxes = [F.try_variant_get(v, f"$.{p}", "array<double>") for p in ("bounding_box", "bbox", "box")]
    box = F.coalesce(*[F.when(F.size(b) == 4, b) for b in boxes])
    return payloads.select(
        *[c for c in payloads.columns if c != payload],
        get("text", "value", "content", "raw_text", t="string").alias("text"),
        F.when(conf > 1, conf / 100).otherwise(conf).alias("confidence"),
        get("page_number", "page", "page_num", t="int").alias("page_number"),
        F.coalesce(*[F.nullif(F.try_variant_get(v, f"$.{p}", "string"), F.lit("")) for p in ("element_type", "type", "label")], F.lit("text")).alias("element_type"),
        F.when(box.isNotNull(), F.struct(*[F.get(box, i).alias(n) for i, n in enumerate("xywh")])).alias("bounding_box"),
    )


def last_wins(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """The last value of every key."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def cache_misses(docs: DataFrame, cached: DataFrame, key: str = "document_id") -> DataFrame:
    """Documents that the cache lacks."""
    return docs.join(cached.select(key).distinct(), key, "left_anti")
