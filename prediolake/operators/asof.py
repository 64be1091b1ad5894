"""As-of join: each row with the last record of its key at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof(rows: DataFrame, records: DataFrame, key: str, at: str, since: str, fields: Sequence[str], slice_seconds: int, order: Sequence[str] = ()) -> DataFrame:
    """``rows`` with the ``fields`` (and ``since``) of the last of the ``records`` whose ``since`` isn't after ``at``; null where there is none.

    Records of one key and time are told apart by ``order``: the greatest counts. Both sides are put in one table and
    a running last value goes over each key and slice of time, so neither is matched with the other row by row. What
    holds at the beginning of a slice comes from a second, small table with a row for each key and slice; so a key with
    a third of all rows is split by time and no task gets it whole.

    Rows with a null key or time have no record; records with a null key or time are left out; repeated rows stay.
    """
    slice_of = lambda c: F.floor(F.unix_timestamp(c) / slice_seconds)
    known = records.filter(F.col(key).isNotNull() & F.col(since).isNotNull())
    value = F.struct(F.col(since).alias("since"), *(F.col(c).alias(f"f{n}") for n, c in enumerate(fields)))
    rank = F.struct(F.col(since).alias("t"), *(F.col(c).alias(f"o{n}") for n, c in enumerate(order)))
    right = known.select(F.col(key).alias("_key"), slice_of(F.col(since)).alias("_slice"), rank.alias("_rank"), value.alias("_value"))
    whole = F.struct(*(F.col(c) for c in rows.columns))
    left = rows.select(F.col(key).alias("_key"), slice_of(F.col(at)).alias("_slice"), F.col(at).alias("_at"), whole.alias("_row"))

    both = left.select("_key", "_slice", "_at", F.lit(1).alias("_side"), "_row", F.lit(None).cast(right.schema["_rank"].dataType).alias("_rank"), F.lit(None).cast(right.schema["_value"].dataType).alias("_value"))
    both = both.unionByName(right.select("_key", "_slice", F.col("_rank.t").alias("_at"), F.lit(0).alias("_side"), F.lit(None).cast(left.schema["_row"].dataType).alias("_row"), "_rank", "_value"))
    running = Window.partitionBy("_key", "_slice").orderBy("_at", "_side", "_rank").rowsBetween(Window.unboundedPreceding, 0)
    within = both.withColumn("_found", F.last("_value", ignorenulls=True).over(running)).filter("_side = 1").select("_key", "_slice", "_row", "_found")

    ends = right.groupBy("_key", "_slice").agg(F.max_by("_value", "_rank").alias("_end"))
    slices = ends.unionByName(left.groupBy("_key", "_slice").agg(F.lit(None).cast(right.schema["_value"].dataType).alias("_end")))
    slices = slices.groupBy("_key", "_slice").agg(F.max("_end").alias("_end"))  # at most one isn't null
    before = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.withColumn("_carried", F.last("_end", ignorenulls=True).over(before)).filter("_carried IS NOT NULL").select("_key", "_slice", "_carried")
    found = F.coalesce("_found", "_carried")
    joined = within.join(carried, ["_key", "_slice"], "left")
    return joined.select("_row.*", found["since"].alias(since), *(found[f"f{n}"].alias(c) for n, c in enumerate(fields)))
