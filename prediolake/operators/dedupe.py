"""Keep one row of a key, or mark the keys that repeat."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType


def _one(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], pick) -> DataFrame:
    """An aggregate of whole rows rather than a window: it is combined before the shuffle, so a key that repeats very often is a row to each task."""
    rest = [c for c in df.columns if c not in keys]
    names = [c for c in order if isinstance(c, str) and c in rest]
    if len(names) == len(order) == len(set(names)) and all(isinstance(f.dataType, AtomicType) for f in df.schema if f.name in rest):  # the row itself is in order, its order needn't be carried beside it
        pick, rest = (F.max if pick is F.max_by else F.min), [*names, *(c for c in rest if c not in names)]
        picked = df.groupBy(*keys).agg(pick(F.struct(*rest)).alias("_row"))
        return picked.select(*(F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns))
    picked = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*[c if isinstance(c, Column) else F.col(c) for c in order])).alias("_row"))
    return picked.select(*(F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns))


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    return _one(df, keys, order, F.max_by)


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    return _one(df, keys, order, F.min_by)


def mark_repeated(df: DataFrame, keys: Sequence[str], out: str = "repeated") -> DataFrame:
    """Adds whether the row's key occurs more than once. The keys are counted, combined before the shuffle, and joined back, so no task gathers a frequent key's rows; nulls are equal."""
    counts = df.groupBy(*(F.col(c).alias(f"_key_{c}") for c in keys)).agg((F.count(F.lit(1)) > 1).alias(out))
    same = reduce(Column.__and__, (df[c].eqNullSafe(counts[f"_key_{c}"]) for c in keys))
    return df.join(counts, same).select(*(df[c] for c in df.columns if c != out), counts[out])
