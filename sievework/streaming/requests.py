"""Request records as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.routing import SCHEMA, Route, decisions, routed


def read_requests(spark: SparkSession, folder: str, kind: str = "parquet") -> DataFrame:
    """Files of request records as they arrive in a folder."""
    return spark.readStream.format(kind).schema(SCHEMA).load(folder)


def log_decisions(records: DataFrame, route: Route, target: str, checkpoint: str, kind: str = "parquet") -> StreamingQuery:
    """Routes what has arrived and appends the decisions to target; the checkpoint makes each record count once."""
    rows = decisions(routed(records, route))
    return rows.writeStream.format(kind).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(target)
