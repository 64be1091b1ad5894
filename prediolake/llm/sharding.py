"""Sharding by Karmarkar-Karp differencing: near-equal bytes for groups that can't be divided."""

from __future__ import annotations

import heapq
from collections.abc import Hashable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket, number_rows, salts_for, save


def differencing(items: Iterable[tuple[Hashable, int]], ways: int) -> dict[Hashable, int]:
    """Deal (key, size) items to ``ways`` parts of near-equal size.

    Each item begins as a partial partition of its own: the item and ways-1 empty parts. The two partial partitions
    with the largest spread (largest part less smallest) are combined again and again, the largest part of one with
    the smallest of the other, until one is left. Ties go by the order of the items. No items: an empty dict.
    """
    heap = [(-size, k, [size] + [0] * (ways - 1), [(key,)] + [()] * (ways - 1)) for k, (key, size) in enumerate(sorted(items, key=lambda x: (-x[1], str(x[0]))))]
    heapq.heapify(heap)
    count = len(heap)
    while len(heap) > 1:
        _, _, sums, parts = heapq.heappop(heap)
        _, _, others, more = heap[0]
        joined = sorted(((s + o, i) for i, (s, o) in enumerate(zip(sums, reversed(others), strict=True))), reverse=True)
        last = ways - 1
        made = [(parts[i], more[last - i]) if parts[i] and more[last - i] else parts[i] or more[last - i] for _, i in joined]
        heapq.heapreplace(heap, (joined[-1][0] - joined[0][0], count, [s for s, _ in joined], made))
        count += 1
    out: dict[Hashable, int] = {}
    for part, tree in enumerate(heap[0][3] if heap else ()):
        stack = [tree]
        while stack:
            x = stack.pop()
            if len(x) == 2:
                stack.extend(x)
            elif x:
                out[x[0]] = part
    return out


def shard_by_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 24, overhead: int = 8, bundles: int = 8192, giant_share: int = 400) -> DataFrame:
    """Shards of near-equal bytes; equal texts stay together.

    Returns doc_id, size, text_crc32, shard, slot: one row for each row of docs, other columns aside. size: UTF-8
    bytes of the text and ``overhead``. A null text has no bytes and goes with the empty text. Repeated rows are
    rows like others (equal texts, so one shard). slot: 0, 1, ... within a shard. An empty table gives no rows.

    The differencing runs on the driver, over at most bundles + shards * giant_share items however large the table:
    groups with at least total / (shards * giant_share) bytes are items by themselves, and there can't be more of
    them than that quotient; the others are bundled by their text's hash. So groups aren't split, a group that holds
    a third of all bytes gets a shard to itself, and only the items' sizes are collected. Both assignment tables are
    bounded likewise, so they may be broadcast.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = save(
        docs.select(F.col(id_col).alias("doc_id"), text.alias("_t")).select(
            "doc_id", (F.octet_length("_t") + overhead).cast("long").alias("size"), F.crc32(F.col("_t").cast("binary")).cast("long").alias("text_crc32"),
            F.xxhash64("_t").alias("_k1"), F.xxhash64(F.lit("second key"), "_t").alias("_k2"),
        ).withColumn("_bundle", bucket(bundles, "_k2", "_k1")),
        "shard-base",
    )
    totals = base.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    least = max(1, totals["bytes"] // (shards * giant_share))
    groups = save(base.groupBy("_k1", "_k2", "_bundle").agg(F.sum("size").alias("bytes")), "shard-groups")
    giants = [((r["_k1"], r["_k2"]), r["bytes"]) for r in groups.filter(F.col("bytes") >= least).collect()] if totals["rows"] else []
    packs = [(r["_bundle"], r["bytes"]) for r in groups.filter(F.col("bytes") < least).groupBy("_bundle").agg(F.sum("bytes").alias("bytes")).collect()]
    place = differencing([*giants, *packs], shards)
    big = spark.createDataFrame([(k[0], k[1], place[k]) for k, _ in giants], "_k1 long, _k2 long, _own int")
    small = spark.createDataFrame([(k, place[k]) for k, _ in packs], "_bundle int, _with int")
    dealt = base.join(F.broadcast(big), ["_k1", "_k2"], "left").join(F.broadcast(small), ["_bundle"], "left")
    dealt = dealt.withColumn("shard", F.coalesce("_own", "_with")).select("doc_id", "size", "text_crc32", "shard")
    return number_rows(dealt, ["shard"], ["doc_id", "text_crc32", "size"], "slot", salts_for(totals["rows"], shards))
