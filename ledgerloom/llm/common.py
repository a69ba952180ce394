"""Shared plumbing of the text operators: table readers, Arrow text maps, delivery-aware flags."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import cut  # noqa: F401

#: Entries a worker keeps of texts it has already looked at; the memo only saves repeated work.
MEMO = 60_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def arrow_text(arr: pa.Array) -> pa.Array:
    return arr if pa.types.is_large_string(arr.type) else arr.cast(pa.large_string())


def over_texts(batch: pa.RecordBatch, columns: list[str], fn: Callable[[list], list], dtype, memo: dict) -> list[np.ndarray]:
    """fn over the distinct texts of several columns of a batch; a text seen before is looked up in memo."""
    arrays = [arrow_text(batch.column(c)) for c in columns]
    enc = pa.chunked_array(arrays).combine_chunks().dictionary_encode()
    words = enc.dictionary.to_pylist()
    new = [w for w in words if w not in memo]
    if len(memo) + len(new) > MEMO:
        memo.clear()
        new = words
    for w, v in zip(new, fn(new)):
        memo[w] = v
    vals = np.fromiter((memo[w] for w in words), dtype=dtype, count=len(words))
    vals = np.append(vals, np.zeros(1, dtype=dtype))
    idx = np.asarray(enc.indices.fill_null(len(words)))
    flat = vals[idx]
    n = batch.num_rows
    return [flat[i * n : (i + 1) * n] for i in range(len(columns))]


def flag_masks(df: DataFrame, key: str, fields: list[str], make: Callable[[], Callable[[list], list]], bits: int, ts: str = "loaded_at") -> DataFrame:
    """(row_key, mask): what `make()` finds in each field, of the latest delivery of every key.

    The texts stay where they are read: only key, time and one packed long a row are shuffled. Field i has
    the bits from i*bits. Deliveries with equal time: the larger mask. A null time counts as earliest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn, memo = make(), {}
        for b in batches:
            if not b.num_rows:
                continue
            cols = over_texts(b, fields, fn, np.int64, memo)
            mask = np.zeros(b.num_rows, np.int64)
            for i, c in enumerate(cols):
                mask |= c << (i * bits)
            yield pa.RecordBatch.from_arrays([b.column("row_key"), b.column("at"), pa.array(mask)], names=["row_key", "at", "mask"])

    at = F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(-(2**62)).cast("long"))
    src = df.select(F.col(key).cast("long").alias("row_key"), at.alias("at"), *fields)
    got = src.mapInArrow(run, "row_key long, at long, mask long")
    return got.groupBy("row_key").agg(F.max(F.struct("at", "mask"))["mask"].alias("mask")).filter("mask <> 0")


def explode_masks(masks: DataFrame, fields: list[str], kinds: list[str], bits: int, kind_name: str, source: str | None = None) -> DataFrame:
    """One row per set bit."""
    pairs = [
        F.when(F.col("mask").bitwiseAND(1 << (i * bits + j)) != 0, F.struct(F.lit(f).alias("field_name"), F.lit(k).alias(kind_name)))
        for i, f in enumerate(fields)
        for j, k in enumerate(kinds)
    ]
    out = masks.select("row_key", F.explode(F.array_compact(F.array(*pairs))).alias("x"))
    cols = ([F.lit(source).alias("source_table")] if source else []) + ["row_key", "x.field_name", f"x.{kind_name}"]
    return out.select(*cols)


def latest(df: DataFrame, key: str, ts: str, cols: list[str]) -> DataFrame:
    """The latest delivery of every key (ties: the greatest row)."""
    at = F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(-(2**62)).cast("long"))
    g = df.groupBy(key).agg(F.max(F.struct(at.alias("_at"), *cols)).alias("_r"))
    return g.select(key, *[F.col(f"_r.{c}").alias(c) for c in cols])
