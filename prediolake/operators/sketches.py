"""Sketches of a scrape that are stored and merged later, in place of its rows: distinct values, quantiles, frequent values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the distinct counter (error about 1 / sqrt(2^LG), 0.8 %), size of the quantile sketch, most tracked values.
LG, QUANTILES, TRACKED = 14, 400, 1000


def sketch(rows: DataFrame, keys: Sequence[str], distinct: str, measure: str, frequent: str) -> DataFrame:
    """(keys, n, distinct, quantiles, frequent): one row of sketches for each key, combined before the shuffle; of a bounded size whatever the rows. Nulls count in ``n`` alone."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(distinct, LG).alias("distinct"), F.kll_sketch_agg_bigint(F.col(measure).cast("long"), QUANTILES).alias("quantiles"),
        F.expr(f"approx_top_k_accumulate({frequent}, {TRACKED})").alias("frequent"),
    )


def merge(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketches of fewer keys: as if all rows had been sketched at once."""
    return sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_bigint("quantiles", QUANTILES).alias("quantiles"), F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent")
    )


def estimates(sketches: DataFrame, keys: Sequence[str], ranks: Sequence[float] = (0.25, 0.5, 0.75), top: int = 3) -> DataFrame:
    """(keys, n, distinct, quantiles, frequent): estimated distinct values, the measure at each of the ranks, and the ``top`` values with their counts."""
    at = F.array(*(F.kll_sketch_get_quantile_bigint("quantiles", F.lit(r)) for r in ranks))
    return sketches.select(*keys, "n", F.hll_sketch_estimate("distinct").alias("distinct"), at.alias("quantiles"), F.expr(f"approx_top_k_estimate(frequent, {top})").alias("frequent"))
