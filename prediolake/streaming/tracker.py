"""Changes of a value along a stream, by states of keys that outlive the batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Fixed value: the groups that keys are dealt to; a stream's checkpoint holds for one number of them.
GROUPS = 512


def _tracked(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    known = pd.DataFrame(dict(zip(("key", "micros", "value"), state.get if state.exists else ([], [], []), strict=True))).assign(tie=0, new=False)
    rows = pd.concat([known, *(b[["key", "micros", "value", "tie"]].assign(new=True) for b in batches)] if len(known) else [b[["key", "micros", "value", "tie"]].assign(new=True) for b in batches], ignore_index=True)
    rows["code"] = pd.factorize(rows["key"])[0]
    if len(known):  # keys of the state come first, so its rows' codes are their places
        since = np.full(rows["code"].max() + 1, np.iinfo(np.int64).min)
        since[: len(known)] = known["micros"]
        rows = rows[~rows["new"] | (rows["micros"] >= since[rows["code"]])]  # others are older than what has been told
    rows = rows.sort_values(["code", "micros", "new", "tie"], kind="stable", ignore_index=True)
    same = rows["code"].eq(rows["code"].shift())
    before = rows["value"].shift(fill_value=0)
    changed = same & (rows["value"] != before)
    last = rows[~rows["code"].eq(rows["code"].shift(-1))]
    state.update(tuple(last[c].tolist() for c in ("key", "micros", "value")))
    yield pd.DataFrame({"key": rows["key"], "micros": rows["micros"], "before": before, "after": rows["value"]})[changed]


def changes(rows: DataFrame, key: str, at: str, value: str, tie: str, groups: int = GROUPS) -> DataFrame:
    """(key, at, before, after) each time the value of a key differs from the one before.

    rows: a stream. The state of a key is its last time and value, so it is two numbers whatever has gone by. The rows
    of one batch are put in order by ``at`` and ``tie``; a row older than what an earlier batch has told of its key is
    left out. Rows with a null key, time or value are left out; equal values in a row are one. Keys are dealt to
    ``groups`` by their hashes and a group's are told of in one call, as a call a key takes far longer than its rows. A
    task holds the rows of one group and batch, of four numbers each, and its keys' states: the source's files in a
    batch bound the rows.
    """
    kind = rows.schema[key].dataType.simpleString()
    held = rows.filter(F.col(key).isNotNull() & F.col(at).isNotNull() & F.col(value).isNotNull())
    slim = held.select(F.col(key).alias("key"), F.unix_micros(F.col(at).cast("timestamp")).alias("micros"), F.col(value).cast("long").alias("value"), F.coalesce(F.col(tie).cast("long"), F.lit(2**63 - 1)).alias("tie"))
    dealt = slim.withColumn("dealt", F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int"))
    found = dealt.groupBy("dealt").applyInPandasWithState(_tracked, f"key {kind}, micros long, before long, after long", f"key array<{kind}>, micros array<long>, value array<long>", "append", GroupStateTimeout.NoTimeout)
    return found.select(F.col("key").alias(key), F.timestamp_micros("micros").alias(at), "before", "after")
