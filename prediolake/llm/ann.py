"""Approximate nearest neighbours: a hierarchical navigable small-world graph for each shard, kept as flat neighbour arrays."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucket, save

#: An index row; its vectors are of the table's own type.
INDEX_SCHEMA = "dim int, shard int, entry int, top int, levels array<int>, ids array<long>, id_ends array<int>, vectors array<{kind}>, links0 array<int>, upper_at array<int>, links array<int>"


class Graph:
    """A small-world graph over vectors of one shard, built and searched for the largest inner product.

    The vectors get one more component, so that all are of the same length and the largest inner product is also the
    smallest distance; a query's is 0. links[level][node]: its neighbours there, at most ``m`` (twice that on level 0).
    """

    def __init__(self, vectors: np.ndarray, m: int = 16, ef: int = 80):
        self.m, self.ef = m, ef
        vectors = vectors / (np.abs(vectors).max(initial=0.0) or 1.0)
        squares = np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64)
        more = np.sqrt(np.maximum(0.0, squares.max(initial=0.0) - squares))
        self.x = np.ascontiguousarray(np.c_[vectors, more], dtype=np.float32)
        self.links: list[list[list[int]]] = []
        self.levels: list[int] = []
        self.entry = -1

    def build(self, seeds: list[int]) -> None:
        """Insert all nodes in order; a node's level comes from its seed, so it is the same in every run."""
        for k, seed in enumerate(seeds):
            u = (xxhash.xxh64_intdigest(int(seed).to_bytes(8, "little", signed=True), seed=1) + 1) / (2**64 + 1)
            self._insert(k, int(-math.log(u) / math.log(self.m)))

    def _insert(self, node: int, level: int) -> None:
        self.levels.append(level)
        while len(self.links) <= level:
            self.links.append([[] for _ in range(len(self.x))])
        if self.entry < 0:
            self.entry = node
            return
        q = self.x[node]
        top = self.levels[self.entry]
        near = [(float(self.x[self.entry] @ q), self.entry)]
        for at in range(top, level, -1):
            near = self._search(q, near, 1, at)
        for at in range(min(top, level), -1, -1):
            near = self._search(q, near, self.ef, at)
            links = self.links[at]
            links[node] = self._select(near, self.m)
            most = self.m * (2 if at == 0 else 1)
            for other in links[node]:
                links[other].append(node)
                if len(links[other]) > most:
                    sims = self.x[links[other]] @ self.x[other]
                    links[other] = self._select(sorted(zip(sims.tolist(), links[other], strict=True), reverse=True), most)
        if level > top:
            self.entry = node

    def _select(self, near: list[tuple[float, int]], most: int) -> list[int]:
        """Of the candidates, nearest first, those nearer to the node than to any chosen one; then the nearest of the others."""
        if len(near) <= most:
            return [n for _, n in near]
        nodes = [n for _, n in near]
        between = self.x[nodes] @ self.x[nodes].T
        closest = np.full(len(nodes), -np.inf, dtype=np.float32)
        chosen, rest = [], []
        for k, (sim, n) in enumerate(near):
            if sim > closest[k]:
                chosen.append(n)
                if len(chosen) == most:
                    return chosen
                np.maximum(closest, between[k], out=closest)
            else:
                rest.append(n)
        return chosen + rest[: most - len(chosen)]

    def _search(self, q: np.ndarray, starts: list[tuple[float, int]], ef: int, level: int) -> list[tuple[float, int]]:
        """The ``ef`` best (inner product, node) found from the starts on a level, best first."""
        links, x, push, pop = self.links[level], self.x, heapq.heappush, heapq.heappop
        seen = bytearray(len(x))
        for _, n in starts:
            seen[n] = 1
        ahead = [(-s, n) for s, n in starts]
        heapq.heapify(ahead)
        best = sorted(starts)[-ef:]
        heapq.heapify(best)
        while ahead:
            s, n = pop(ahead)
            if len(best) >= ef and -s < best[0][0]:
                break
            new = [o for o in links[n] if not seen[o]]
            if not new:
                continue
            for o in new:
                seen[o] = 1
            for sim, o in zip((x[new] @ q).tolist(), new, strict=True):
                if len(best) < ef:
                    push(best, (sim, o))
                    push(ahead, (-sim, o))
                elif sim > best[0][0]:
                    heapq.heapreplace(best, (sim, o))
                    push(ahead, (-sim, o))
        return sorted(best, reverse=True)

    def nearest(self, query: np.ndarray, ef: int) -> list[int]:
        """Nodes by falling inner product with a query vector."""
        q = np.append(query / (np.abs(query).max(initial=0.0) or 1.0), 0.0).astype(np.float32)
        near = [(float(self.x[self.entry] @ q), self.entry)]
        for at in range(self.levels[self.entry], 0, -1):
            near = self._search(q, near, 1, at)
        return [n for _, n in self._search(q, near, ef, 0)]

    def flat(self) -> dict:
        """links0: 2m slots a node, -1 where empty; links: from upper_at[node] on, m slots for each of its levels from 1."""
        def padded(links: list[int], width: int) -> list[int]:
            return links + [-1] * (width - len(links))

        upper_at, upper = [0], []
        for n, level in enumerate(self.levels):
            for at in range(1, level + 1):
                upper += padded(self.links[at][n], self.m)
            upper_at.append(len(upper))
        return {"entry": self.entry, "top": max(self.levels), "levels": self.levels, "links0": [v for n in range(len(self.levels)) for v in padded(self.links[0][n], 2 * self.m)], "upper_at": upper_at, "links": upper}

    @classmethod
    def load(cls, row: pd.Series, m: int = 16) -> Graph:
        graph = cls(np.asarray(row["vectors"]).reshape(-1, int(row["dim"])), m)
        graph.levels, graph.entry = [int(v) for v in row["levels"]], int(row["entry"])
        n = len(graph.levels)
        graph.links = [[[] for _ in range(n)] for _ in range(int(row["top"]) + 1)]
        base, at, upper = np.asarray(row["links0"]).reshape(n, -1).tolist(), row["upper_at"], np.asarray(row["links"])
        graph.links[0] = [[v for v in links if v >= 0] for links in base]
        for k, level in enumerate(graph.levels):
            for a in range(1, level + 1):
                start = int(at[k]) + (a - 1) * m
                graph.links[a][k] = [int(v) for v in upper[start : start + m] if v >= 0]
        return graph


def _build(pdf: pd.DataFrame, m: int, ef: int) -> pd.DataFrame:
    pdf = pdf.sort_values("_id", kind="stable")
    rows = np.stack([np.asarray(v) for v in pdf["_v"]])
    nodes: dict[bytes, list[int]] = {}
    first: list[int] = []
    for k, (key, vec) in enumerate(zip(pdf["_id"].tolist(), rows, strict=True)):
        same = nodes.setdefault(vec.tobytes(), [])
        if not same:
            first.append(k)
        if not same or same[-1] != key:
            same.append(key)
    vectors = rows[first]
    graph = Graph(vectors, m, ef)
    graph.build([ids[0] for ids in nodes.values()])
    flat = graph.flat()
    ends = np.cumsum([len(v) for v in nodes.values()]).tolist()
    return pd.DataFrame([{"dim": rows.shape[1], "shard": int(pdf["_shard"].iloc[0]), **flat, "ids": [k for v in nodes.values() for k in v], "id_ends": ends, "vectors": vectors.ravel()}])


def usable(vec: Column) -> Column:
    """Not null, without null or non-finite components, and not all zero."""
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec.isNotNull() & F.coalesce(good & F.exists(vec, lambda x: x != 0), F.lit(False))


def _rows(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, str]:
    """(_id, _v) of the usable rows, and the type of the components: float where the table has float, else double."""
    kind = "float" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{vec_col}`").cast(f"array<{kind}>").alias("_v"))
    return rows.filter(F.col("_id").isNotNull() & usable(F.col("_v"))), kind


def build_index(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", shard_rows: int = 8192, shards_first: int = 64, shard_values: int = 1 << 23, m: int = 16, ef: int = 80) -> DataFrame:
    """One row (INDEX_SCHEMA) for each shard, saved in the shared folder.

    A row's shard depends on its id's hash, so equal vectors are spread; within a shard they are one node that bears
    all their ids. A query is searched in every shard, so there should be few: shards hold about ``shard_rows`` rows
    until there are ``shards_first`` of them, and then grow until they hold ``shard_values`` components, which bounds a
    task's memory; only beyond that does their number grow. Repeated rows are one; an id that bears several vectors is
    a candidate by each. Rows that aren't usable take no part; vectors of different lengths are in different shards.
    An empty table: no shards.
    """
    rows, kind = _rows(vectors, id_col, vec_col)
    rows = rows.withColumn("_dim", F.size("_v"))
    n, dim = rows.agg(F.count(F.lit(1)), F.max("_dim")).first()
    most = max(shard_rows, shard_values // (dim or 1))
    shards = max(1, -(-n // min(most, max(shard_rows, -(-n // shards_first)))))
    dealt = rows.withColumn("_shard", bucket(shards, "_id")).repartition(shards, "_dim", "_shard").groupBy("_dim", "_shard")
    return save(dealt.applyInPandas(partial(_build, m=m, ef=ef), INDEX_SCHEMA.format(kind=kind)), "ann-index")


def _find(key: tuple, queries: pd.DataFrame, index: pd.DataFrame, k: int, m: int, ef: int) -> Iterator[pd.DataFrame] | pd.DataFrame:
    out: dict[int, list[tuple[float, int]]] = {}
    for _, row in index.iterrows():
        graph = Graph.load(row, m)
        exact = np.asarray(row["vectors"]).reshape(-1, int(row["dim"])).astype(np.float64)
        ids, ends = np.asarray(row["ids"]), np.asarray(row["id_ends"])
        asked = {(own, np.asarray(v).tobytes()): np.asarray(v, dtype=np.float64) for own, v in zip(queries["_id"].tolist(), queries["_v"], strict=True)}
        for (own, _), q in asked.items():
            near = graph.nearest(q, ef)
            scores = (exact[near] * q).sum(axis=1)
            best: dict[int, float] = {}
            kept: list[float] = []
            for s, n in sorted(zip((-scores).tolist(), near, strict=True)):
                if len(kept) >= k and s > kept[k - 1]:
                    break
                for i in ids[ends[n - 1] if n else 0 : ends[n]][: k + 1].tolist():
                    if i != own and i not in best:
                        best[i] = s
                        kept.append(s)
            for s, i in out.get(own, ()):
                best[i] = min(s, best.get(i, s))
            out[own] = sorted((s, i) for i, s in best.items())[:k]
    return pd.DataFrame([(own, [{"s": s, "i": i} for s, i in found]) for own, found in out.items()], columns=["query_id", "near"])


def nearest(index: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, m: int = 16, ef: int = 120, block: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's ``k`` nearest found in all shards, nearest first, ties to the smaller id.

    score: the inner product in double precision of the original vectors; the query's own id is left out. Each shard
    is searched by blocks of queries and gives one row a query; the rows of a query, one for each shard, are merged.
    Repeated rows ask once, and an id is found once; an id that bears several vectors asks with each, and its best
    scores count. Queries that aren't usable, or whose length no shard has, have no rows; no queries or no shards: none.
    """
    rows = _rows(queries, id_col, vec_col)[0].withColumn("dim", F.size("_v"))
    blocks = max(1, -(-rows.count() // block))
    asked = rows.withColumn("_block", bucket(blocks, "_id")).join(F.broadcast(index.select(F.col("dim").alias("_d"), F.col("shard").alias("_s"))), F.col("dim") == F.col("_d"))
    shards = index.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    tasks = max(1, index.count() * blocks)
    asked, shards = (x.select(F.struct(*names).alias("_key"), *rest) for x, names, rest in ((asked, ("_d", "_s", "_block"), ("_id", "_v")), (shards, ("dim", "shard", "_block"), index.columns)))
    asked, shards = (x.withColumn("_key", F.concat_ws(":", "_key.*")).repartition(tasks, "_key") for x in (asked, shards))
    pairs = asked.groupBy("_key").cogroup(shards.groupBy("_key"))
    found = pairs.applyInPandas(partial(_find, k=k, m=m, ef=ef), "query_id long, near array<struct<s:double,i:long>>")
    merged = found.groupBy("query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))
    placed = merged.select("query_id", F.posexplode("near").alias("at", "x"))
    return placed.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.i").alias("vec_id"), (-F.col("x.s")).alias("score"))
