"""Merges of listings with detail records and small dimensions, on one key each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedupe import last_wins


def _details(details: DataFrame, key: str, fields: Sequence[str], order: str) -> DataFrame:
    """One record a key, the last, under names that no listing has; a key that repeats would repeat listings."""
    return last_wins(details, [key], [order]).select(F.col(key).alias("_key"), *(F.col(c).alias(f"_d_{c}") for c in fields))


def _said(field: str, kind: str) -> Column:
    """A record's field; null where it is 0 or ''."""
    return F.nullif(F.col(f"_d_{field}"), F.lit("" if kind == "string" else 0).cast(kind))


def overwrite(cards: DataFrame, details: DataFrame, fields: Sequence[str], key: str = "url", order: str = "pos") -> DataFrame:
    """A record found replaces all fields, zeros included; cards without one stay."""
    joined = cards.join(_details(details, key, fields, order), cards[key] == F.col("_key"), "left")
    return joined.select(*(F.when(F.col("_key").isNotNull(), F.col(f"_d_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in cards.columns))


def fill(cards: DataFrame, details: DataFrame, fields: Sequence[str], key: str = "url", order: str = "pos") -> DataFrame:
    """A record's fields that aren't 0 or '' replace the card's."""
    joined = cards.join(_details(details, key, fields, order), cards[key] == F.col("_key"), "left")
    kinds = dict(cards.dtypes)
    return joined.select(*(F.coalesce(_said(c, kinds[c]), F.col(c)).alias(c) if c in fields else F.col(c) for c in cards.columns))


def fill_first(cards: DataFrame, details: DataFrame, fields: Sequence[str], seq: Sequence[str], key: str = "url", order: str = "pos") -> DataFrame:
    """Like fill, but only the first card of a key, by ``seq``, is changed. ``seq`` tells a key's cards apart."""
    firsts = cards.groupBy(F.col(key).alias("_first")).agg(F.min(F.struct(*seq)).alias("_seq"))  # combined before the shuffle: a frequent key is a row to each task
    record = _details(details, key, fields, order).join(firsts, F.col("_key") == F.col("_first"))
    joined = cards.join(record, (cards[key] == F.col("_key")) & (F.struct(*(cards[c] for c in seq)) == F.col("_seq")), "left")
    kinds = dict(cards.dtypes)
    return joined.select(*(F.coalesce(_said(c, kinds[c]), F.col(c)).alias(c) if c in fields else F.col(c) for c in cards.columns))


def thresholds(results: DataFrame, portals: DataFrame) -> DataFrame:
    """Runs beside the least number of listings of their portal (0 where it isn't known), with a message where they fall short."""
    joined = results.join(F.broadcast(portals.select("portal", "min_listings")), "portal", "left").withColumn("min_listings", F.coalesce("min_listings", F.lit(0)))
    short = F.concat("portal", F.lit(": "), F.col("listings").cast("string"), F.lit(" listings (min "), F.col("min_listings").cast("string"), F.lit(")"))
    failed = F.concat("portal", F.lit(": FAILED — "), F.coalesce(F.nullif("error", F.lit("")), F.lit("unknown error")))
    return joined.withColumn("warning", F.when(~F.col("ok"), failed).when(F.col("listings") < F.col("min_listings"), short))
