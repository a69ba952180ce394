"""Problem 7: texts put into containers of fixed capacity.

Bulk-synchronous best-fit over classes of equal sizes. Documents are range-sorted by size, containers by
gap. In each round the largest size that is left sweeps to its successor, the smallest gap that holds it;
conflicts are settled by rank (the first documents of the class take the first containers of the gap), gaps
are updated, and the round repeats. As equal sizes are interchangeable, a round moves whole classes, of which
there are at most as many as the capacity has tokens: the rounds of a capacity run where its classes are, on a worker,
and what they give - rank intervals on container intervals - stays a table. Documents and intervals then sweep past
each other in streams sorted by rank, in blocks of ranks, so that a size that a third of all documents have is many tasks.
The result is that of one-by-one best-fit decreasing. Nothing is collected or broadcast but the few capacities.

Odd input: null texts are no items; empty ones (no tokens) go to container 0; a text over the capacity is
cut into full containers and a rest (part_no counts its parts); equal rows are items of their own.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .tok import VOCABULARY, sizes

#: Documents of a rank block; ranks of a size are made block by block.
BLOCK = 50_000


def best_fit(histogram: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """(rows of size, first rank, count, first container), containers: best-fit decreasing over classes."""
    plan: list[tuple[int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []
    bins = 0

    def put(gap: int, first: int, n: int) -> None:
        if n and gap:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((first, n))

    def fill(size: int, rank: int, left: int, gap: int, first: int, n: int) -> int:
        """Put up to left documents into n containers from first with this gap; how many were put."""
        each = gap // size
        full = min(n, left // each)
        for j in range(each if full else 0):
            plan.append((size, rank + j * full, full, first))
        put(gap - each * size, first, full)
        done = each * full
        if full < n and done < left:  # the last container takes the rest
            rest = left - done
            for j in range(rest):
                plan.append((size, rank + done + j, 1, first + full))
            put(gap - rest * size, first + full, 1)
            done, full = left, full + 1
        put(gap, first + full, n - full)
        return done

    for size in sorted((s for s in histogram if s > 0), reverse=True):
        left, rank = histogram[size], 0
        while left:
            at = bisect_left(order, size)
            if at < len(order):
                gap = order[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    order.pop(at)
            else:
                gap, first = capacity, bins
                n = -(-left // (capacity // size))
                bins += n
            done = fill(size, rank, left, gap, first, n)
            rank += done
            left -= done
    return np.array(plan, np.int64).reshape(-1, 4), bins


def pack(docs: DataFrame, limits: list[tuple[int, int]]) -> DataFrame:
    """(limit_id, container_id, doc_id, part_no, tokens). docs: doc_id, tokens; limits: (limit_id, capacity)."""
    table = F.array(*[F.struct(F.lit(i).cast("int").alias("limit_id"), F.lit(c).cast("long").alias("cap")) for i, c in limits])
    held = docs.filter("tokens is not null").select("doc_id", "tokens", F.explode(table).alias("l")).select("l.*", "doc_id", "tokens")
    whole = held.filter("tokens <= cap").select("limit_id", "doc_id", F.lit(0).alias("part_no"), "tokens")
    long = held.filter("tokens > cap").select("limit_id", "doc_id", "cap", "tokens", F.explode(F.expr("sequence(0, cast((tokens - 1) div cap as int))")).alias("part_no"))
    parts = whole.unionByName(long.select("limit_id", "doc_id", "part_no", F.least("cap", F.col("tokens") - F.col("part_no") * F.col("cap")).alias("tokens")))
    classes = cut(parts.groupBy("limit_id", "tokens").count())
    total = classes.groupBy("limit_id").agg(F.sum("count").alias("n")).agg(F.max("n")).first()[0] or 0
    blocks = max(1, total // BLOCK)
    caps = dict(limits)

    def rounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hist: dict[int, dict[int, int]] = {}
        for b in batches:
            for i, size, n in zip(*(b.column(c).to_pylist() for c in ("limit_id", "tokens", "count"))):
                hist.setdefault(i, {})[size] = n
        for i, h in hist.items():
            p = best_fit(h, caps[i])[0]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), i, np.int32)), *(pa.array(p[:, c]) for c in (0, 1, 2, 3))], names=["limit_id", "tokens", "rank", "n", "container_id"])

    plan = classes.repartition(max(1, len(limits)), "limit_id").mapInArrow(rounds, "limit_id int, tokens long, rank long, n long, container_id long")
    # ranks: within a block by window, blocks by a running sum over their counts (blocks x sizes rows)
    parts = parts.withColumn("block", F.pmod(F.xxhash64("doc_id", "part_no"), F.lit(blocks)).cast("int"))
    key = ["limit_id", "tokens"]
    local = parts.withColumn("r", F.row_number().over(Window.partitionBy(*key, "block").orderBy("doc_id", "part_no")) - 1)
    if blocks > 1:
        counts = parts.groupBy(*key, "block").count()
        before = counts.withColumn("before", F.sum("count").over(Window.partitionBy(*key).orderBy("block")) - F.col("count"))
        local = local.join(before.drop("count").hint("merge"), [*key, "block"])  # sizes x blocks rows: never broadcast
        local = local.withColumn("r", F.col("r") + F.col("before"))
    rows = local.select("limit_id", F.col("tokens").cast("long").alias("tokens"), F.col("r").cast("long").alias("rank"), "doc_id", "part_no")
    # a rank interval is there in every block of ranks that it meets
    within = lambda r: F.floor(r / BLOCK).cast("long")
    spans = plan.withColumn("ranks", F.explode(F.sequence(within(F.col("rank")), within(F.col("rank") + F.col("n") - 1))))
    none = F.lit(None)
    stream = spans.select("limit_id", "tokens", "ranks", "rank", F.lit(0).alias("turn"), "container_id", none.cast("long").alias("doc_id"), none.cast("int").alias("part_no"))
    stream = stream.unionByName(rows.filter("tokens > 0").select("limit_id", "tokens", within(F.col("rank")).alias("ranks"), "rank", F.lit(1).alias("turn"), none.cast("long").alias("container_id"), "doc_id", "part_no"))
    order = ["limit_id", "tokens", "ranks"]
    stream = stream.repartition(*order).sortWithinPartitions(*order, "rank", "turn")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = 0  # container less rank of the interval in hand, also over the end of a batch
        for b in batches:
            if not b.num_rows:
                continue
            turn, rank = np.asarray(b.column("turn")), np.asarray(b.column("rank"))
            to = np.asarray(b.column("container_id").fill_null(0)) - rank
            starts = np.flatnonzero(turn == 0)
            at = np.searchsorted(starts, np.arange(len(turn)), side="right") - 1
            moved = np.where(at >= 0, to[starts[np.maximum(at, 0)]] if len(starts) else shift, shift)
            if len(starts):
                shift = int(to[starts[-1]])
            docs = pa.array(np.flatnonzero(turn == 1))
            c = pa.array(rank + moved)
            yield pa.RecordBatch.from_arrays([b.column("limit_id").take(docs), c.take(docs), *(b.column(x).take(docs) for x in ("doc_id", "part_no", "tokens"))], names=["limit_id", "container_id", "doc_id", "part_no", "tokens"])

    put = stream.mapInArrow(place, "limit_id int, container_id long, doc_id long, part_no int, tokens long")
    empty = rows.filter("tokens = 0").select("limit_id", F.lit(0).cast("long").alias("container_id"), "doc_id", "part_no", "tokens")
    return put.unionByName(empty)


def packed(corpus: DataFrame, limits: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """pack() over the texts of a corpus and the `pack` rows of size_limits."""
    caps = [(r[0], r[1]) for r in limits.filter("purpose = 'pack'").select("limit_id", "max_tokens").orderBy("limit_id").collect()]
    return pack(cut(sizes(corpus, path=path)), caps)


def kept(placed: DataFrame, corpus: DataFrame, limits: DataFrame) -> DataFrame:
    """(limit_id, documents, over_full, split_needlessly) of an assignment: documents placed, containers over their size, documents cut though they fit."""
    caps = F.broadcast(limits.filter("purpose = 'pack'").select("limit_id", F.col("max_tokens").alias("cap")))  # a handful of rows
    load = placed.groupBy("limit_id", "container_id").agg(F.sum("tokens").alias("load"), F.count("*").alias("n")).join(caps, "limit_id")
    over = load.groupBy("limit_id").agg(F.count_if((F.col("load") > F.col("cap")) & (F.col("container_id") >= 0)).alias("over_full"))
    docs = placed.groupBy("limit_id", "doc_id").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("parts")).join(caps, "limit_id")
    return docs.groupBy("limit_id").agg(F.count("*").alias("documents"), F.count_if((F.col("parts") > 1) & (F.col("tokens") <= F.col("cap"))).alias("split_needlessly")).join(over, "limit_id")
