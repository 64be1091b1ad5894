"""The listings table in partitions that are refreshed in place: a scrape rewrites the portals that it touches and no others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lifecycle import refresh
from ..schemas import STORED
from .scratch import keep

_COLUMNS = [f for f in STORED if f.name != "portal"]


def create(spark: SparkSession, name: str, location: str, buckets: int = 8) -> None:
    """A catalog table, a partition for each portal and buckets of ids within it, so that joins on id need no shuffle of it."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in _COLUMNS)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, portal string) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (portal) CLUSTERED BY (id) INTO {buckets} BUCKETS LOCATION '{location}'")


def _insert(rows: DataFrame, name: str) -> None:
    """Overwrite the partitions that rows has, and these alone: the table's own option says so (a writer's option doesn't reach insertInto)."""
    rows.select(*(f.name for f in _COLUMNS), "portal").write.insertInto(name, overwrite=True)


def load(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Fill the partitions of the rows' portals, in place of what they had."""
    _insert(rows, name)


def touched(spark: SparkSession, name: str, batch: DataFrame) -> list[str]:
    """The portals whose partitions a batch changes: its own, and those that hold its ids now. As many values as portals at most."""
    now = spark.table(name).select("id", "portal").join(batch.select("id").distinct(), "id", "left_semi").select("portal")
    return sorted(r.portal for r in now.union(batch.select("portal")).distinct().collect() if r.portal is not None)


def refresh_partitions(spark: SparkSession, name: str, batch: DataFrame, order: Sequence[str]) -> list[str]:
    """Refresh the table with a scrape (its scope goes inactive, then the batch is upserted); the portals that were rewritten.

    Only their partitions are read and written. Their next state is saved first and then put in place partition by
    partition, each at once; a run that breaks off can be begun again and ends in the same table. A partition that has
    no rows left is dropped. An empty batch changes nothing.
    """
    portals = touched(spark, name, batch)
    if not portals:
        return []
    current = spark.table(name).filter(F.col("portal").isin(portals)).select(*STORED.names)
    after = keep(refresh(current, batch, order).select(*STORED.names), "refresh")
    _insert(after, name)
    left = {r.portal for r in after.select("portal").distinct().collect()}
    for portal in set(portals) - left:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (portal = '{portal}')")
    return portals


def analyze(spark: SparkSession, name: str, columns: Sequence[str] = ("id", "precio", "estrato")) -> None:
    """Row counts and column statistics, which the optimizer uses for join sizes."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
