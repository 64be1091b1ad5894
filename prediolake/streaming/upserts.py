"""Scrapes that arrive as files keep the listings table current."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.lifecycle import refresh
from ..schemas import STORED
from ..sources.store import ListingStore


def follow(spark: SparkSession, source: str, store: ListingStore, checkpoint: str, order: Sequence[str] = ("scraped_at", "id")) -> StreamingQuery:
    """Each micro-batch of Parquet files under ``source`` is one scrape: its scope is refreshed and a version is committed.

    A batch that is run again after a failure gives the same table: rows are upserted by id. One trigger takes all
    files that are there and then the query ends.
    """
    def apply(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            store.commit(lambda table: refresh(table, batch.select(*STORED.names), order))

    stream = spark.readStream.schema(STORED).parquet(source)
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
