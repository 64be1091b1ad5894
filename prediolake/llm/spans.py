"""Substring dedup over sliding sentence spans, and over windows of 51 words."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import save, through_arrow

#: A sentence: up to closing marks and the white space after them, or to the end of a line.
_SENTENCE = re.compile(r"[^.!?\n]*(?:[.!?]+(?!\s|$)[^.!?\n]*)*(?:[.!?]+\s*|\n\s*|$)")
#: Words of a window, and of the grams whose least hash in a window is its anchor.
PASSAGE, GRAM = 51, 12
_BASE = 0x9E3779B97F4A7C15


def sentences(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of the text's sentences; together they are the whole text.

    A sentence ends after . ! or ? before white space, or at the end of a line, and holds the white space that
    follows. Null and empty texts have none.
    """
    return [m.span() for m in _SENTENCE.finditer(text or "") if m.end() > m.start()]


def span_hashes(text: str | None, run: int, least_words: int) -> list[tuple[int, int, bytes]]:
    """(position of its first sentence, sentences, 128-bit hash) of every run of consecutive sentences: ``run``, or as many more as it takes to reach ``least_words`` words; the last runs end with the text, so only one that is shorter as a whole has none. White space and case make no difference."""
    words = [text[a:b].lower().split() for a, b in sentences(text)]
    marked = [" ".join(w) for w in words]
    ends = [0, *accumulate(map(len, words))]
    out = []
    stop = 0
    for k in range(len(words) - run + 1):
        stop = max(stop, k + run)
        while stop < len(words) and ends[stop] - ends[k] < least_words:
            stop += 1
        if ends[stop] - ends[k] < least_words:
            break
        out.append((k, stop - k, xxhash.xxh3_128_digest("\n".join(marked[k:stop]))))
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def windows(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, hash) of each window of PASSAGE words of the text, by its first word. White space and case make no difference.

    The anchor is the least hash of the window's grams of GRAM words: equal windows have equal anchors, and
    neighbouring ones mostly share theirs, so a text has an anchor for about every 20 words.
    """
    words = (text or "").lower().split()
    n = len(words)
    if n < PASSAGE:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    powers = np.full(n, _BASE, dtype=np.uint64)
    powers[0] = 1
    back = np.full(n, pow(_BASE, -1, 2**64), dtype=np.uint64)
    back[0] = 1
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(hashes * np.cumprod(powers), dtype=np.uint64)])
    back = np.cumprod(back)
    grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * back[: n - GRAM + 1])
    least, width, most = grams, 1, PASSAGE - GRAM + 1
    while width < most:
        step = min(width, most - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return least.view(np.int64), _mixed((sums[PASSAGE:] - sums[:-PASSAGE]) * back[: n - PASSAGE + 1]).view(np.int64)


_SKETCH = "doc_id long, part long, pos array<int>, n array<int>, h1 array<long>, h2 array<long>, anchors array<long>"


def _sketched(batches: Iterator[pa.RecordBatch], run: int, least_words: int, at_once: int = 512) -> Iterator[pa.RecordBatch]:
    """From (doc_id, text, part): a text's spans (pos, n, h1, h2) and the anchors of its windows."""
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    for whole in batches:
        for at in range(0, whole.num_rows, at_once):
            b = whole.slice(at, at_once)
            pos, n, h1, h2, anchors = [], [], [], [], []
            for text in b.column(1).to_pylist():
                found = span_hashes(text, run, least_words)
                halves = np.frombuffer(b"".join([h for _, _, h in found]), dtype="<i8").reshape(-1, 2)
                pos.append([k for k, _, _ in found])
                n.append([c for _, c, _ in found])
                h1.append(halves[:, 0].copy())
                h2.append(halves[:, 1].copy())
                anchors.append(np.unique(windows(text)[0]))
            arrays = [pa.array(pos, ints), pa.array(n, ints), pa.array(h1, longs), pa.array(h2, longs), pa.array(anchors, longs)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *arrays], ["doc_id", "part", "pos", "n", "h1", "h2", "anchors"])


def _windowed(batches: Iterator[pa.RecordBatch], at_once: int = 512) -> Iterator[pa.RecordBatch]:
    """From (doc_id, text, part, hot): the hashes of the text's windows that have one of the hot anchors."""
    for whole in batches:
        for at in range(0, whole.num_rows, at_once):
            b = whole.slice(at, at_once)
            found = []
            for text, hot in zip(b.column(1).to_pylist(), b.column(3), strict=True):
                anchors, hashes = windows(text)
                found.append(np.unique(hashes[np.isin(anchors, hot.values.to_numpy())]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "part", "hashes"])


def _repeated(places: DataFrame, keys: list[str], place: Column, tag: str) -> DataFrame:
    """The rows of places whose keys stand at two places or more, with the first of these as ``first``.

    The keys are counted first, combined before the shuffle, and only those that repeat are joined back: no task
    gathers the places of a frequent key, and Spark can split its join.
    """
    ends = places.groupBy(*keys).agg(F.min(place).alias("first"), F.max(place).alias("last"))
    return places.join(save(ends.filter("first <> last").drop("last"), tag), keys)


def covered_passages(rows: DataFrame, sketch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (doc_id, text, part) and its sketch: (doc_id, part, h), the hashes of windows that stand in an earlier document too, and (doc_id, part) of the texts of PASSAGE words or more that are those of an earlier document.

    No repeated window is missed: an anchor that two texts have is found first, and only windows with such an anchor
    are then compared. Each text takes part once, in the place of its smallest doc_id.
    """
    long = sketch.filter(F.size("anchors") > 0).select("doc_id", "part", "anchors")
    texts = save(long.groupBy("part").agg(F.min("doc_id").alias("doc_id"), F.first("anchors").alias("hashes")), "span-texts")
    copies = long.select("doc_id", "part").join(texts.select("part", F.col("doc_id").alias("least")), "part").filter("doc_id > least").select("doc_id", "part")
    place = F.struct("doc_id", "part")
    hot = _repeated(texts.select("doc_id", "part", F.explode("hashes").alias("h")), ["h"], place, "span-hot").groupBy("doc_id", "part").agg(F.collect_set("h").alias("hot"))
    asked = rows.join(hot, ["doc_id", "part"]).select("doc_id", "text", "part", "hot")
    found = save(through_arrow(asked, _windowed, "doc_id long, part long, hashes array<long>"), "span-windows")
    again = _repeated(found.select("doc_id", "part", F.explode("hashes").alias("h")), ["h"], place, "span-passages")
    return again.filter(place != F.col("first")).select("doc_id", "part", "h"), copies


def _named(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column, Column]:
    """A document's id, its text, and the text's hash."""
    text = docs[f"`{text_col}`"].cast("string")
    return docs[f"`{id_col}`"].cast("long"), text, F.xxhash64(text)


def covered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = 2, least_words: int = 12) -> DataFrame:
    """(doc_id, part, positions, windows, whole): the sentences that a repeated span covers, but for its first place; the hashes of the windows that an earlier document has; whether an earlier document has the same text.

    part is the text's hash: with doc_id it names a document even where a doc_id bears several texts. The first place
    of a span is the one with the smallest doc_id, part and position. A document's positions are gathered at the end,
    at most its own sentences and words.
    """
    key, text, part = _named(docs, id_col, text_col)
    rows = docs.select(key.alias("doc_id"), text.alias("text"), part.alias("part")).filter("doc_id IS NOT NULL")
    sketch = save(through_arrow(rows, partial(_sketched, run=run, least_words=least_words), _SKETCH), "span-sketch")
    spans = sketch.select("doc_id", "part", F.inline(F.arrays_zip("pos", "n", "h1", "h2")))
    place = F.struct("doc_id", "part", "pos")
    again = _repeated(spans, ["h1", "h2"], place, "span-firsts").filter(place != F.col("first"))
    repeated, copies = covered_passages(rows, sketch)
    none = F.lit(None)
    found = again.select("doc_id", "part", F.sequence("pos", F.col("pos") + F.col("n") - 1).alias("run"), none.cast("long").alias("h"), F.lit(False).alias("whole"))
    found = found.union(repeated.select("doc_id", "part", none.cast("array<int>"), "h", F.lit(False))).union(copies.select("doc_id", "part", none.cast("array<int>"), none.cast("long"), F.lit(True)))
    return found.groupBy("doc_id", "part").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("run")))).alias("positions"), F.collect_set("h").alias("windows"), F.max("whole").alias("whole"))


def _cut(text: str, positions: list[int], found: list[int], whole: bool) -> tuple[str, list[tuple[int, int]], int]:
    """The text without the sentences at the positions and the windows found, the removed (start, end) with neighbours joined, and how many sentences they touch."""
    parts = sentences(text)
    gone = [(0, len(text))] if whole else [parts[k] for k in positions]
    if found and not whole:
        starts = [m.start() for m in re.finditer(r"\S+", text)] + [len(text)]
        at = np.flatnonzero(np.isin(windows(text)[1], np.array(found, dtype=np.int64))).tolist()
        gone += [(starts[k], starts[k + PASSAGE]) for k in at]
    removed: list[tuple[int, int]] = []
    for a, b in sorted(gone):
        if removed and a <= removed[-1][1]:
            removed[-1] = (removed[-1][0], max(b, removed[-1][1]))
        else:
            removed.append((a, b))
    edges = [0, *(x for pair in removed for x in pair), len(text)]
    kept = "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
    touched, k = 0, 0
    for a, b in parts:
        while k < len(removed) and removed[k][1] <= a:
            k += 1
        touched += k < len(removed) and removed[k][0] < b
    return kept, removed, touched


def _cleaned(batches: Iterator[pa.RecordBatch], names: list[str], text_at: int, at_once: int = 512) -> Iterator[pa.RecordBatch]:
    """From (row, positions, windows, whole): the row's columns with the text cut, and what was cut."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for whole_batch in batches:
        for at in range(0, whole_batch.num_rows, at_once):
            b = whole_batch.slice(at, at_once)
            columns = b.column(0).flatten()
            texts, removed, n = [], [], []
            for text, positions, hashes, whole in zip(columns[text_at].to_pylist(), *(b.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                kept, spans, count = _cut(text, positions, hashes, whole) if positions or hashes or whole else (text, [], 0)
                texts.append(kept)
                removed.append([{"start": x, "end": y} for x, y in spans])
                n.append(count)
            columns[text_at] = pa.array(texts, pa.string())
            cut = pa.StructArray.from_arrays([pa.array(removed, span), pa.array(n, pa.int32())], ["removed", "n"])
            yield pa.RecordBatch.from_arrays([*columns, cut], names)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = 2, least_words: int = 12, out: str = "repeats") -> DataFrame:
    """All rows and columns of docs, the text without the sentences that a repeated span covers, but for its first place, and without every window of 51 words that an earlier document has; and ``out``: removed, the (start, end) cut from the old text, in code points, and n, the sentences cut, whole or in part.

    The windows slide word by word, so a passage of over 50 words goes from its first word to its last, whatever its
    sentences are. Repeats within one document go by sentences only.
    Null texts and rows without an id stay as they are. Rows with the same doc_id and text count as one document, so
    they get the same result; a text all of whose sentences go is left empty. Of equal spans the one with the smallest
    doc_id stays. An empty table gives no rows. Columns may have any names but ``out``, which raises an error.
    """
    if out in docs.columns:
        raise ValueError(f"docs has a column {out} already")
    gone = save(covered(docs, id_col, text_col, run, least_words), "span-gone")  # its shuffles' files go before the texts are shuffled
    key, _, part = _named(docs, id_col, text_col)
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), key.alias("doc_id"), part.alias("part"))
    joined = rows.join(gone, ["doc_id", "part"], "left").select("row", "positions", "windows", "whole")
    cut = StructType([StructField("removed", ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))), StructField("n", IntegerType())])
    fields = [StructField(f.name, StringType() if f.name == text_col else f.dataType) for f in docs.schema]
    return through_arrow(joined, partial(_cleaned, names=[*docs.columns, out], text_at=docs.columns.index(text_col)), StructType([*fields, StructField(out, cut)]))
