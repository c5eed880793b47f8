"""Votes as a stream of page records: per-document summaries and per-filing checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def watch_cells(cells: DataFrame, late: str = "1 hour", window: str = "1 day") -> DataFrame:
    """Per window and document of a stream of cells: cells, voters (approximate) and mean confidence.

    Cells later than ``late`` behind the newest are left out; state is dropped as windows close.
    """
    return cells.withWatermark("loaded_at", late).groupBy(F.window("loaded_at", window), "doc_id").agg(
        F.count("*").alias("n_cells"), F.approx_count_distinct("voter").alias("n_voters"), F.avg("confidence").alias("mean_confidence")
    ).select(F.col("window.start").alias("window_start"), "doc_id", "n_cells", "n_voters", "mean_confidence")


def watch_sessions(cells: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Per document the bursts in which its cells arrive."""
    return cells.withWatermark("loaded_at", late).groupBy(F.session_window("loaded_at", gap), "doc_id").agg(F.count("*").alias("n_cells")).select(F.col("session_window.start").alias("started"), F.col("session_window.end").alias("ended"), "doc_id", "n_cells")


def each_batch(stream: DataFrame, operator: Callable[[DataFrame], DataFrame], folder: str, checkpoint: str):
    """Run a batch operator over every micro-batch and append its result; replayed batches overwrite their own part."""

    def write(batch: DataFrame, n: int) -> None:
        operator(batch).write.mode("overwrite").parquet(f"{folder}/batch={n}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
