"""The run log kept up to date from a stream of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import upsert


def keep_run_log(rows: DataFrame, path: str, checkpoint: str, key: list[str], counters: list[str]) -> StreamingQuery:
    """Folds each micro-batch of a stream to one row per key and appends it under its batch number.

    A batch that is run again replaces its own part, so counters are added once, however often it is tried.
    current_log() folds the parts to one row per key.
    """

    def fold(batch: DataFrame, number: int) -> None:
        upsert.run_log(batch, key, counters).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return rows.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_log(parts: DataFrame, key: list[str], counters: list[str]) -> DataFrame:
    return upsert.run_log(parts.drop("batch"), key, counters)


def sessions(events: DataFrame, late: str = "1 hour", gap: str = "30 minutes") -> DataFrame:
    """Searches per site and session, rows up to `late` behind the newest counted."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "site_id").agg(F.count("*").alias("n"), F.sum("web_searches").alias("web_searches"))
