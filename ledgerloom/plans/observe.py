"""Timings of the stages of a run, and what it runs on."""

from __future__ import annotations

import os
import platform
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


class Stages:
    """Milliseconds of named stages, three decimals. A stage is measured even where it fails."""

    def __init__(self) -> None:
        self.times: dict[str, float] = {}

    @contextmanager
    def measure(self, name: str) -> Iterator[None]:
        began = time.perf_counter()
        try:
            yield
        finally:
            self.times[name] = round((time.perf_counter() - began) * 1000, 3)

    @property
    def total(self) -> float:
        return round(sum(self.times.values()), 3)


def environment(spark: SparkSession, paths: dict[str, str] | None = None) -> dict[str, str]:
    """What a run runs on: versions, cluster, cores, settings, and which of the named paths are there."""
    sc = spark.sparkContext
    out = {"python": platform.python_version(), "spark": spark.version, "master": sc.master, "parallelism": str(sc.defaultParallelism), "time_zone": spark.conf.get("spark.sql.session.timeZone"), "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions")}
    out |= {f"path_{n}": f"{p} ({'there' if os.path.exists(p) else 'missing'})" for n, p in (paths or {}).items()}
    return out


def format_environment(report: dict[str, str]) -> str:
    """One line for each entry, names in order and in a column."""
    wide = max(map(len, report), default=0)
    return "\n".join(f"{k:<{wide}}  {report[k]}" for k in sorted(report))
