"""Windows over event time: sessions and sliding windows that close by a watermark, with state that Spark keeps and late rows that it drops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def sessions(rows: DataFrame, key: str, at: str, gap: str, late: str, measures: Sequence[Column]) -> DataFrame:
    """(key, began, ended, measures) of each stretch of a key's rows of which no two neighbours lie ``gap`` or more apart; ended is the last row's time and the gap.

    Over a stream, rows may come out of order: a session is given once, when the watermark (the latest time seen less
    ``late``) reaches its end, and rows whose own session would have ended before the watermark are dropped. Over a
    table the same plan gives all sessions.
    """
    windowed = rows.withWatermark(at, late).groupBy(F.col(key), F.session_window(at, gap).alias("_w")).agg(*measures)
    return windowed.select(key, F.col("_w.start").alias("began"), F.col("_w.end").alias("ended"), *windowed.columns[2:])


def sliding(rows: DataFrame, keys: Sequence[str], at: str, width: str, slide: str, late: str, measures: Sequence[Column]) -> DataFrame:
    """(keys, began, ended, measures) of each window of ``width`` that begins every ``slide``; windows close and late rows go as in sessions."""
    windowed = rows.withWatermark(at, late).groupBy(*keys, F.window(at, width, slide).alias("_w")).agg(*measures)
    return windowed.select(*keys, F.col("_w.start").alias("began"), F.col("_w.end").alias("ended"), *windowed.columns[len(keys) + 1 :])


def arrivals(spark: SparkSession, source: str, schema: StructType, files: int) -> DataFrame:
    """A stream of the Parquet files under a folder, in order of their arrival, ``files`` in a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)


def run(result: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write what has closed to Parquet files, from where the checkpoint stands to the end of what has arrived, and wait. A run that is begun again after a failure gives no row twice."""
    query = result.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query
