"""Structured Streaming variants: windows with late data, sessions, state of a document, bundles written batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def throughput(events: DataFrame, at: str = "ts", by: str = "event_type", size: str = "1 hour", late: str = "2 days", slide: str | None = None) -> DataFrame:
    """Counts and value sums of tumbling windows, or of sliding ones; events later than the watermark are dropped."""
    window = F.window(at, size, slide) if slide else F.window(at, size)
    w = events.withWatermark(at, late).groupBy(window, by)
    return w.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), by, "n", "total")


def sessions(elements: DataFrame, at: str = "loaded_at", by: str = "document_id", gap: str = "30 minutes") -> DataFrame:
    """A document's elements that arrive within a gap of each other belong together."""
    s = elements.withWatermark(at, gap).groupBy(F.session_window(at, gap), by)
    return s.agg(F.count("*").alias("n")).select(by, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def running_counts(elements: DataFrame, by: str = "document_id") -> DataFrame:
    """(by, n, pages, batches) after every batch: how many elements and pages of a document have come so far. State is three numbers a document."""

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, pages, batches = state.get if state.exists else (0, 0, 0)
        for f in frames:
            n += len(f)
            top = f["page_number"].max()
            pages = max(pages, 0 if pd.isna(top) else int(top))
        state.update((n, pages, batches + 1))
        yield pd.DataFrame({by: [key[0]], "n": [n], "pages": [pages], "batches": [batches + 1]})

    return elements.select(by, "page_number").groupBy(by).applyInPandasWithState(update, f"{by} string, n long, pages long, batches long", "n long, pages long, batches long", "update", GroupStateTimeout.NoTimeout)


def read_files(spark, path: str, schema, per_trigger: int = 16, pattern: str | None = None) -> DataFrame:
    """A folder as a stream, so many files a batch."""
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger)
    return (r.option("pathGlobFilter", pattern) if pattern else r).parquet(path)


def run_once(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Everything that is there now, then stop."""
    q = df.writeStream.outputMode(mode).format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def run_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Everything that is there now, each batch given to write(rows, batch number), then stop."""
    q = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
