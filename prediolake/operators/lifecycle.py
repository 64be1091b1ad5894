"""The listings table across scrapes: upsert by id, scopes that go inactive, and what a load changed.

Each function gives the table's next version as a plan; sources.store writes it and swaps the pointer. Rows that an
incoming batch replaces are found by id alone, so one full outer comparison is one shuffle of each side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedupe import last_wins


def deactivate(table: DataFrame, portal: Column | str, ciudad: Column | str) -> DataFrame:
    """Active rows of the portal and city become inactive."""
    portal, ciudad = (F.lit(x) if isinstance(x, str) else x for x in (portal, ciudad))
    hit = (F.col("portal") == portal) & (F.col("ciudad") == ciudad) & (F.col("status") == "active")
    return table.withColumn("status", F.when(hit, "inactive").otherwise(F.col("status")))


def upsert(table: DataFrame, batch: DataFrame, order: Sequence[str], at: Column | None = None, drop_empty_ids: bool = True) -> DataFrame:
    """The table with the batch's rows: of one id the last by ``order``, active, stamped ``at``.

    Rows without an id have no identity: they are left out (quarantine() gives them), or, with drop_empty_ids off,
    share the id '' and the last stays.
    """
    rows = batch.filter(F.col("id") != "") if drop_empty_ids else batch
    rows = rows.withColumn("status", F.lit("active"))
    if at is not None:
        rows = rows.withColumn("scraped_at", at)
    new = last_wins(rows, ["id"], order).select(*table.columns)
    return table.join(new.select("id"), "id", "left_anti").select(*table.columns).unionByName(new)


def quarantine(batch: DataFrame) -> DataFrame:
    """Rows of a batch that have no id."""
    return batch.filter(F.coalesce(F.col("id"), F.lit("")) == "")


def refresh(table: DataFrame, batch: DataFrame, order: Sequence[str], at: Column | None = None, drop_empty_ids: bool = True) -> DataFrame:
    """A scrape's snapshot: the scope of the batch's first row, if it has portal and city, goes inactive, then the batch is upserted."""
    scope = batch.agg(F.min_by(F.struct("portal", "ciudad"), F.struct(*order)).alias("_scope"))
    marked = table.crossJoin(F.broadcast(scope))  # one row
    hit = (F.col("portal") == F.col("_scope.portal")) & (F.col("ciudad") == F.col("_scope.ciudad")) & (F.col("portal") != "") & (F.col("ciudad") != "") & (F.col("status") == "active")
    off = marked.withColumn("status", F.when(F.coalesce(hit, F.lit(False)), "inactive").otherwise(F.col("status"))).select(*table.columns)
    return upsert(off, batch, order, at, drop_empty_ids)


def delisted(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of the table whose id the batch hasn't."""
    return table.join(batch.select("id").distinct(), "id", "left_anti").select(*table.columns)


def load_delta(table: DataFrame, batch: DataFrame) -> DataFrame:
    """One row: how many rows the batch has, how many ids are new to the table, and the rest (repeats included)."""
    ids = batch.select("id").distinct()
    new = ids.join(table.select("id"), "id", "left_anti").agg(F.count(F.lit(1)).alias("new_rows"))
    return batch.agg(F.count(F.lit(1)).alias("batch_rows")).crossJoin(new).withColumn("refreshed", F.col("batch_rows") - F.col("new_rows"))
