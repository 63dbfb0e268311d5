"""Micro-batches against a cache of known keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.operators.pick import new_keys
from strandwise.session import exists


class KeyCache:
    """Keys seen so far as Parquet parts, one folder per batch; a batch that is delivered again replaces its own part."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.path, self.keys = spark, path, keys

    def known(self, before: int | None = None) -> DataFrame | None:
        if not exists(self.spark, self.path):  # nothing written yet; a broken cache is an error, it would let all keys in again
            return None
        df = self.spark.read.parquet(self.path)
        return df if before is None else df.where(F.col("batch") < before)

    def add(self, batch: DataFrame, number: int) -> None:
        """Keeps the rows with keys that no earlier batch held; safe to repeat."""
        rows = batch.select(*self.keys).distinct()
        known = self.known(number)
        fresh = rows if known is None else new_keys(rows, known, self.keys)
        fresh.write.mode("overwrite").parquet(f"{self.path}/batch={number}")


def first_seen(stream: DataFrame, cache: KeyCache, checkpoint: str):
    """Runs the stream to its present end and keeps each key once."""
    q = stream.writeStream.foreachBatch(lambda df, n: cache.add(df, n)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def windowed_counts(stream: DataFrame, at: str, by: str, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Rows per event-time window and key; rows later than `late` are left out by the watermark."""
    return stream.withWatermark(at, late).groupBy(F.window(at, window), by).agg(F.count(F.lit(1)).alias("n"))
