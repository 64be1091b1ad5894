"""Range join: pairs of periods that overlap, by bins of time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overlapping(left: DataFrame, right: DataFrame, keys: Sequence[str], a: tuple[str, str], b: tuple[str, str], bin_seconds: int, salts: int = 1) -> DataFrame:
    """Every pair of a left and a right row with equal ``keys`` whose periods share time: left.* and right.* but its keys.

    a, b: the columns with the beginning and the end (not included) of each side's periods; other names must differ.
    A row stands in each bin that its period touches, the sides meet on keys and bin, and of the bins that two periods
    share only the first decides, so a pair is given once and without a distinct. An equi-join with a filter: no row
    meets rows of other bins. Bins of about the usual length of a period make about two rows of each; a period makes
    as many rows as it touches bins. ``salts`` spreads a bin of very many rows: its left rows are dealt, its right rows
    repeated.

    Periods that are empty, end before they begin, or have a null end or beginning overlap nothing; so do null keys.
    """

    def binned(df: DataFrame, period: tuple[str, str], salt) -> DataFrame:
        began, ended = (F.unix_micros(F.col(c).cast("timestamp")) for c in period)
        size = bin_seconds * 1_000_000
        first, last = F.floor(began / size), F.floor((ended - 1) / size)
        held = df.filter(F.col(period[0]) < F.col(period[1]))
        dealt = held.withColumn("_bin", F.explode(F.sequence(first, last)))
        return dealt.withColumn("_salt", salt) if salts > 1 else dealt

    x = binned(left, a, F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    y = binned(right, b, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))) if salts > 1 else F.lit(0))
    y = y.select(*(F.col(c).alias(f"_k{n}") for n, c in enumerate(keys)), F.col("_bin").alias("_bin_y"), *([F.col("_salt").alias("_salt_y")] if salts > 1 else []), *(c for c in right.columns if c not in keys))
    on = x["_bin"] == y["_bin_y"]
    if salts > 1:
        on = on & (x["_salt"] == y["_salt_y"])
    for n, c in enumerate(keys):
        on = on & (x[c] == y[f"_k{n}"])
    begun = F.floor(F.unix_micros(F.greatest(F.col(a[0]).cast("timestamp"), F.col(b[0]).cast("timestamp"))) / (bin_seconds * 1_000_000))  # the later beginning's bin is the first that both touch
    pairs = x.join(y, on).filter((F.col("_bin") == begun) & (F.col(a[0]) < F.col(b[1])) & (F.col(b[0]) < F.col(a[1])))
    return pairs.select(*left.columns, *(c for c in right.columns if c not in keys))
