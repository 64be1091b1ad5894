"""Ranked lexical search: dual-sorted wavelet trees over shards of documents, searched best node first for exact top k."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import save, through_arrow

#: Terms of the documents of a shard, with repeats; a shard ends with the document that reaches them.
SHARD_TERMS = 2_000_000
#: Cells (nodes by terms) that a search keeps open before it goes on with the deepest nodes alone, and that it opens at once.
OPEN_CELLS, STEP_CELLS = 4_000_000, 16_384
#: Bytes of texts of items that go to the executors in one block.
BLOCK_BYTES = 16 << 20

_TERM = np.ones(256, dtype=bool)
_TERM[:128] = [chr(c).isascii() and chr(c).isalnum() for c in range(128)]
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if _TERM[c] else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Maximal stretches of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased, as UTF-8."""
    return (text or "").encode().translate(_FOLD).split()


def _bytes_of(texts: pa.StringArray) -> tuple[np.ndarray, bytes]:
    """(offsets from 0, bytes) of a column of texts without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return offsets - offsets[0], b"" if data is None else memoryview(data)[int(offsets[0]) : int(offsets[-1])].tobytes()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs = terms = 0
    for b in batches:
        offsets, data = _bytes_of(b.column(0).cast(pa.string()).fill_null(""))
        held = _TERM[np.frombuffer(data, dtype=np.uint8)]
        begins = held.copy()
        begins[1:] &= ~held[:-1]
        firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[firsts] = held[firsts]
        sums = np.concatenate(([0], np.cumsum(begins)))
        n = sums[offsets[1:]] - sums[offsets[:-1]]
        docs, terms = docs + int(np.count_nonzero(n)), terms + int(n.sum())
    yield pa.RecordBatch.from_arrays([pa.array([docs], pa.int64()), pa.array([terms], pa.int64())], ["docs", "terms"])


def impacts_of(tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """What a weight of one gives a document: (1000000000 tf) div (1000 tf + 8 m), m = 25 + (75 n docs) div terms."""
    sizes, at = np.unique(n, return_inverse=True)
    m = np.array([25 + (75 * int(x) * docs) // max(1, terms) for x in sizes], dtype=np.int64)[at]
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


@dataclass
class Tree:
    """A shard's postings: for each term its documents by descending impact, as the levels of a wavelet matrix over document numbers.

    terms: the shard's terms, each with postings starts[t] .. starts[t + 1]; bits: at each level, whether the document's
    number has the bit that the level is for; impacts: in the order of the postings; ids: of the documents.
    """

    terms: pa.BinaryArray
    starts: np.ndarray
    bits: list[np.ndarray]
    impacts: np.ndarray
    ids: pa.Array

    @staticmethod
    def build(terms: pa.BinaryArray, doc: np.ndarray, term: np.ndarray, impacts: np.ndarray, ids: pa.Array) -> Tree:
        """doc, term, impacts: of each posting, a document and a term at most once."""
        order = np.lexsort((doc, -impacts, term))
        doc, impacts = doc[order], impacts[order]
        starts = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=len(terms)))))
        bits, left = [], doc
        for level in range(max(0, len(ids) - 1).bit_length() - 1, -1, -1):
            bit = (left >> level & 1).astype(bool)
            bits.append(bit)
            left = np.concatenate((left[~bit], left[bit]))
        return Tree(terms, starts, bits, impacts, ids)


class Opened:
    """A tree with what a search needs: ranks of zeros and the impacts in the order of each level."""

    def __init__(self, tree: Tree) -> None:
        self.tree, n = tree, len(tree.impacts)
        self.depth = len(tree.bits)
        self.ranks = np.zeros((self.depth, n + 1), dtype=np.int32)
        self.level_impacts = np.empty((self.depth + 1, n), dtype=np.int32)
        left = self.level_impacts[0] = tree.impacts
        for level, bit in enumerate(tree.bits):
            np.cumsum(~bit, out=self.ranks[level, 1:])
            left = self.level_impacts[level + 1] = np.concatenate((left[~bit], left[bit]))
        self.zeros = self.ranks[:, -1].copy()

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, least: int = 0) -> list[tuple[int, int]]:
        """(score, document's number) of the k best documents that score over 0 and not under ``least``, equal scores by ascending number; in no order.

        terms: numbers of different terms of this shard; weights: over 0. A node is a range of document numbers, and
        each term has an interval of postings in it, of which the first has the largest impact: their weighted sum
        bounds the scores below, and in a leaf it is the score. The nodes of the largest bounds are opened first,
        some at a time; nodes whose bound is under the k-th best score go. Where more than OPEN_CELLS are open, the
        deepest nodes are opened first, so that memory stays bounded; the result is the same.
        """
        tree, found = self.tree, []
        low, high = tree.starts[terms][None, :].astype(np.int64), tree.starts[terms + 1][None, :].astype(np.int64)
        level, node = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        held = high > low
        bound = np.where(held, self.level_impacts[0, np.minimum(low, len(tree.impacts) - 1)], 0) @ weights
        step = max(1, STEP_CELLS // max(1, len(terms)))
        while len(bound):
            if len(bound) <= step:
                pick = np.arange(len(bound))
            elif low.size <= OPEN_CELLS:
                pick = np.argpartition(-bound, step)[:step]
            else:
                pick = np.lexsort((-bound, -level))[:step]
            rest = np.ones(len(bound), dtype=bool)
            rest[pick] = False
            a, z, at, number = low[pick], high[pick], level[pick], node[pick]
            ends = at == self.depth
            if ends.any():
                for score, doc in zip(bound[pick][ends].tolist(), number[ends].tolist(), strict=True):
                    item = (score, -doc)
                    if score > 0 and score >= least:
                        if len(found) < k:
                            heapq.heappush(found, item)
                        elif item > found[0]:
                            heapq.heapreplace(found, item)
                if len(found) == k:
                    least = max(least, found[0][0])
                a, z, at, number = a[~ends], z[~ends], at[~ends], number[~ends]
            zeros_a, zeros_z = self.ranks[at[:, None], a], self.ranks[at[:, None], z]
            offset = self.zeros[at][:, None]
            new_low = np.concatenate((zeros_a, offset + a - zeros_a))
            new_high = np.concatenate((zeros_z, offset + z - zeros_z))
            new_level, new_node = np.concatenate((at, at)) + 1, np.concatenate((2 * number, 2 * number + 1))
            held = new_high > new_low
            first = np.where(held, self.level_impacts[new_level[:, None], np.minimum(new_low, len(tree.impacts) - 1)], 0)
            new_bound = first @ weights
            rest &= bound >= least
            on = (new_bound >= max(1, least))
            low, high = np.concatenate((low[rest], new_low[on])), np.concatenate((high[rest], new_high[on]))
            level, node, bound = np.concatenate((level[rest], new_level[on])), np.concatenate((node[rest], new_node[on])), np.concatenate((bound[rest], new_bound[on]))
        return [(score, -doc) for score, doc in found]


class _Shard:
    """Documents gathered for one shard."""

    def __init__(self) -> None:
        self.words: list[pa.Array] = []
        self.counts: list[np.ndarray] = []
        self.ids: list[pa.Array] = []
        self.terms = 0

    def add(self, texts: pa.StringArray, ids: pa.Array) -> None:
        offsets, data = _bytes_of(texts)
        folded = pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data.translate(_FOLD)))
        parts = pc.ascii_split_whitespace(folded)
        words = parts.flatten().cast(pa.binary())
        held = pc.greater(pc.binary_length(words), 0)
        owner = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)[held.to_numpy(zero_copy_only=False)]
        self.words.append(words.filter(held))
        self.counts.append(np.bincount(owner, minlength=len(texts)))
        self.ids.append(ids)
        self.terms += len(owner)

    def tree(self, docs: int, terms: int) -> Tree:
        ids = pa.concat_arrays(self.ids)
        n = np.concatenate(self.counts)
        order = pc.sort_indices(ids).to_numpy()  # ascending ids, null ones last
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.arange(len(order))
        coded = pc.dictionary_encode(pa.chunked_array(self.words, pa.binary()).combine_chunks())
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        pairs, tf = np.unique(code * len(ids) + np.repeat(number, n), return_counts=True)
        term, doc = np.divmod(pairs, max(1, len(ids)))
        return Tree.build(coded.dictionary, doc, term, impacts_of(tf.astype(np.int64), n[order][doc], docs, terms), ids.take(pa.array(order)))


_FIELDS = "terms array<binary>, starts binary, bits binary, impacts binary, documents long"


def _row(tree: Tree, documents: int) -> pa.RecordBatch:
    one = lambda a: pa.array([a.tobytes()], pa.binary())
    lists = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
    bits = np.concatenate([np.packbits(b) for b in tree.bits]) if tree.bits else np.zeros(0, dtype=np.uint8)
    return pa.RecordBatch.from_arrays([lists(tree.terms), one(tree.starts.astype(np.int32)), one(bits), one(tree.impacts.astype(np.int32)), pa.array([documents], pa.int64()), lists(tree.ids)], ["terms", "starts", "bits", "impacts", "documents", "ids"])


def _built(batches: Iterator[pa.RecordBatch], docs: int, terms: int, shard_terms: int) -> Iterator[pa.RecordBatch]:
    """A row for each shard: its tree. A shard has documents of one task that follow one another."""
    shard = _Shard()
    for b in batches:
        texts = b.column(1).cast(pa.string()).fill_null("")
        for at in range(0, len(texts), 256):
            shard.add(texts.slice(at, 256), b.column(0).slice(at, 256))
            if shard.terms >= shard_terms:
                yield _row(shard.tree(docs, terms), docs)
                shard = _Shard()
    if shard.terms:
        yield _row(shard.tree(docs, terms), docs)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_terms: int = SHARD_TERMS) -> DataFrame:
    """A saved table of shards, each a row with its tree (terms, starts, bits, impacts, ids) and the number of all documents that have a term.

    Two reads of the texts, which are never shuffled: one counts documents and terms (impacts depend on both), one
    builds trees of ``shard_terms`` terms each within its tasks. Every document with a term is indexed; null and empty
    texts have none. Repeated rows and ids are documents of their own. No rows: an index without shards.
    """
    text = F.col(text_col).cast("string").alias("_text")
    totals = through_arrow(docs.select(text), _counted, "docs long, terms long").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
    kind = docs.schema[id_col].dataType.simpleString()
    whole = (totals.docs or 0, totals.terms or 0)
    built = partial(_built, docs=whole[0], terms=whole[1], shard_terms=shard_terms)
    return save(through_arrow(docs.select(F.col(id_col).alias("id"), text), built, f"{_FIELDS}, ids array<{kind}>"), "lexical-index")


def _frequencies(batches: Iterator[pa.RecordBatch], asked: list[bytes]) -> Iterator[pa.RecordBatch]:
    wanted, total = pa.array(asked, pa.binary()), np.zeros(len(asked), dtype=np.int64)
    for b in batches:
        for k in range(b.num_rows):
            at = pc.index_in(wanted, value_set=b.column(0)[k].values.cast(pa.binary()))
            starts = np.frombuffer(b.column(1)[k].as_py(), dtype=np.int32)
            here, there = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False)), at.drop_null().to_numpy()
            total[here] += starts[there + 1] - starts[there]
    on = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(on, pa.int32()), pa.array(total[on])], ["term", "df"])


def _searched(batches: Iterator[pa.RecordBatch], queries: list[tuple[np.ndarray, np.ndarray]], asked: list[bytes], k: int) -> Iterator[pa.RecordBatch]:
    """The best k of each query over all shards of a task: the k-th best score so far prunes the shards that follow."""
    wanted, best, id_type = pa.array(asked, pa.binary()), [[] for _ in queries], pa.int64()
    order = lambda item: (-item[0], item[1] is None, item[1])
    for b in batches:
        id_type = b.schema.field("ids").type.value_type
        for row in range(b.num_rows):
            terms, starts, bits, impacts, ids = (b.column(c)[row] for c in ("terms", "starts", "bits", "impacts", "ids"))
            at = pc.index_in(wanted, value_set=terms.values.cast(pa.binary())).fill_null(-1).to_numpy(zero_copy_only=False)
            packed, own = np.frombuffer(bits.as_py(), dtype=np.uint8), np.frombuffer(impacts.as_py(), dtype=np.int32)
            width = max(1, -(-len(own) // 8))
            levels = [np.unpackbits(packed[p : p + width], count=len(own)).astype(bool) for p in range(0, len(packed), width)]
            tree = Opened(Tree(terms.values, np.frombuffer(starts.as_py(), dtype=np.int32), levels, own, ids.values))
            for q, (numbers, weights) in enumerate(queries):
                local = at[numbers]
                on = local >= 0
                if on.any():
                    least = best[q][-1][0] if len(best[q]) == k else 0
                    found = tree.search(local[on], weights[on], k, least)
                    if found:
                        named = [(score, tree.tree.ids[doc].as_py()) for score, doc in found]
                        best[q] = sorted(best[q] + named, key=order)[:k]
    rows = [(q, score, doc) for q, own in enumerate(best) for score, doc in own]
    q, score, doc = zip(*rows, strict=True) if rows else ((), (), ())
    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(score, pa.int64()), pa.array(doc, id_type)], ["query", "score", "doc"])


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def search(index: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text", k: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item, rank, id, score): the ``k`` best documents of each item, equal scores by ascending id, null ids last.

    index: from build_index. Items are searched in blocks of about ``block_bytes`` of text, or of one item, so what goes
    to the executors at once is bounded; every block meets every shard. A task gives k rows of each item at most,
    whatever it reads.

    Items without terms, or whose terms stand in no document or in nearly all (weight 0), have no rows. Items that
    repeat id and text are one; different texts under one id are ranked each by itself. Columns not named are left
    aside, whatever their names.
    """
    spark, first = index.sparkSession, index.select("documents").first()
    documents = first.documents if first else 0
    kind, id_kind = items.schema[item_col].dataType.simpleString(), index.schema["ids"].dataType.elementType.simpleString()
    asked = items.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text")).filter("text is not null").distinct()
    asked = save(asked.withColumn("bytes", F.octet_length("text") + 64), "lexical-items")
    size = asked.agg(F.sum("bytes")).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    out = spark.createDataFrame([], f"`{item_col}` {kind}, rank int, `{id_col}` {id_kind}, score long")
    for block in range(blocks):
        rows = dealt.filter(F.col("block") == block).select("item", "text").collect()
        counted = [Counter(terms_of(r.text)) for r in rows]
        known = sorted({t for c in counted for t in c})
        if not known:
            continue
        df = {r.term: r.df for r in through_arrow(index.select("terms", "starts"), partial(_frequencies, asked=known), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()}
        number = {t: n for n, t in enumerate(known)}
        queries = []
        for c in counted:
            own = [(number[t], times * weight(documents, df[number[t]])) for t, times in c.items() if number[t] in df]
            own = [(n, w) for n, w in own if w > 0]
            queries.append((np.array([n for n, _ in own], dtype=np.int64), np.array([w for _, w in own], dtype=np.int64)))
        found = through_arrow(index.select("terms", "starts", "bits", "impacts", "ids"), partial(_searched, queries=queries, asked=known, k=k), f"query int, score long, doc {id_kind}")
        best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(n, r.item) for n, r in enumerate(rows)], f"query int, item {kind}")
        out = out.unionAll(ranked.join(F.broadcast(names), "query").select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score"))
    return out


def oracle(k: int = 10) -> str:
    """The same in DuckDB SQL, for documents and benchmark."""
    terms = r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
    return f"""
        WITH words AS MATERIALIZED (SELECT doc_id, {terms} AS term FROM documents),
        postings AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
        sizes AS MATERIALIZED (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM postings GROUP BY doc_id),
        whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
        weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM postings, whole GROUP BY term, docs),
        asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {terms} AS term FROM benchmark) GROUP BY item_id, term),
        scored AS (
            SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
            FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (doc_id), whole GROUP BY item_id, doc_id)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= {k}"""
