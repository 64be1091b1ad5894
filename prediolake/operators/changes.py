"""What changed between two scrapes, with multiplicity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows that went and came, as often as they did: the columns and ``change``, 'removed' or 'added'. Equal rows on both sides cancel one by one; nulls are equal."""
    gone = before.exceptAll(after).withColumn("change", F.lit("removed"))
    return gone.unionByName(after.exceptAll(before).withColumn("change", F.lit("added")))


def kept_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows of both, as often as the side that has them less often."""
    return before.intersectAll(after)


def feed(before: DataFrame, after: DataFrame, keys: Sequence[str], compared: Sequence[str]) -> DataFrame:
    """One row for each key that differs: keys, ``change`` ('added', 'removed', 'changed'), ``n_before`` and ``n_after`` (rows) and ``fields``, the compared columns whose values differ as multisets, sorted.

    One pass: each side's rows are counted by key and values, with a sign, so equal rows cancel before anything is
    gathered; a key's differing values come together as counts. Null keys are a key; rows that repeat count.
    """
    names = [*keys, *compared]
    signed = before.select(*names, F.lit(1).alias("_b"), F.lit(0).alias("_a")).unionByName(after.select(*names, F.lit(0).alias("_b"), F.lit(1).alias("_a")))
    rows = signed.groupBy(*names).agg(F.sum("_b").alias("_b"), F.sum("_a").alias("_a"))
    totals = rows.groupBy(*keys).agg(F.sum("_b").alias("n_before"), F.sum("_a").alias("n_after"), F.count_if(F.col("_b") != F.col("_a")).alias("_moved"))
    # per column: a value's count over the key's rows, which differs only if the column does
    stacked = rows.filter("_b <> _a").select(*keys, F.explode(F.array(*(F.struct(F.lit(c).alias("f"), F.col(c).cast("string").alias("v")) for c in compared))).alias("_x"), (F.col("_a") - F.col("_b")).alias("_d"))
    by_value = stacked.groupBy(*keys, F.col("_x.f").alias("_f"), F.col("_x.v").alias("_v")).agg(F.sum("_d").alias("_d")).filter("_d <> 0")
    fields = by_value.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set("_f")), ",").alias("fields"))
    on = None
    for k in keys:
        same = totals[k].eqNullSafe(fields[k])
        on = same if on is None else on & same
    joined = totals.filter("_moved > 0").join(fields, on, "left")
    change = F.when(F.col("n_before") == 0, "added").when(F.col("n_after") == 0, "removed").otherwise("changed")
    return joined.select(*(totals[k] for k in keys), change.alias("change"), "n_before", "n_after", F.coalesce("fields", F.lit("")).alias("fields"))
