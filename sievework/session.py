"""A session for local use; on a cluster the session is the caller's."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session in UTC, with as many shuffle partitions as there are cores to start with."""
    n = cpus or os.cpu_count() or 1
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(n),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    }
    builder = SparkSession.builder.master(f"local[{n}]").appName("sievework").config(map=base | conf)
    return builder.getOrCreate()
