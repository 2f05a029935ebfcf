"""Streams of arriving rows. The reference is batch with file-based state (cleaned log, earlier reports);
these give the same first-wins and skip-known semantics to a stream. An extension, not in the reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def first_seen(stream: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """First arrival of each key within the watermark; state older than ``late`` is dropped."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, by: list[str], time: str, size: str, slide: str | None = None, late: str = "1 day") -> DataFrame:
    """Counts per group and tumbling (or sliding) window of event time, late rows within ``late`` included."""
    return stream.withWatermark(time, late).groupBy(F.window(time, size, slide), *by).agg(F.count("*").alias("n")).select(*by, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n")


def append_unknown(stream: DataFrame, key: str, log_path: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch appends the keys the log doesn't have. A batch that is repeated after a failure adds nothing
    twice, as it reads the log again."""

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        fresh = batch.select(key).where(F.col(key).isNotNull()).distinct()
        try:
            fresh = fresh.join(spark.read.parquet(log_path).select(key), key, "left_anti")
        except Exception as e:  # no log yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
        fresh.write.mode("append").parquet(log_path)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
