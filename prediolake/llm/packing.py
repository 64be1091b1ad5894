"""Best-fit packing by minimum bin slack: documents cut into pieces of at most one sequence, packed into few sequences."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from .common import number_rows, salts_for, save, through_arrow

#: A word of Latin letters and the ASCII signs after it: the tokenizer splits it there and nowhere else.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")
#: White space to str.split(), but not to the tokenizer.
_NOT_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")


def _chunks(text: str | None) -> list[str]:
    if not text:
        return []
    if any(c in text for c in _NOT_SPACE):
        return [c for c in re.split(r"[ \t\n\r\x0b\x0c]+", text) if c]
    return text.split()


class WordTokenizer:
    """Token ids of whole texts, as little-endian unsigned 32-bit ids, by a tokenizer that never joins across white space.

    Words recur, so each is encoded once and kept; the memory of words is emptied beyond ``most`` entries, which
    changes the speed alone.
    """

    def __init__(self, path: str, most: int = 300_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.most = most
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        """A plain lower-case word's ids, straight from the tokenizer's model: its normalizer and splitter leave such a word whole."""
        letters = word if word.isascii() else self.letters.pre_tokenize_str(word)[0][0]
        ids = self.words[word] = struct.pack(f"<{len(found)}I", *found) if (found := [t.id for t in self.model.tokenize(letters)]) else b""
        return ids

    def _learn(self, new: set[str]) -> None:
        words, chunks = self.words, self.chunks
        for c in new:
            if c.isascii() and c.isalpha():
                word, signs = c.lower(), ""
            elif m := _PLAIN.fullmatch(c):
                word, signs = m[1].lower(), m[2]
            else:
                chunks[c] = self._ids(c)
                continue
            ids = words.get(word)
            if ids is None:
                ids = self._word(word)
            if signs:
                tail = self.signs.get(signs)
                if tail is None:
                    tail = self.signs[signs] = self._ids(signs)
                ids += tail
            chunks[c] = ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [_chunks(x) for x in texts]
        if len(self.chunks) > self.most:
            self.chunks.clear()
        if len(self.words) > 2 * self.most:
            self.words.clear()
        if len(self.signs) > self.most:
            self.signs.clear()
        new = set().union(*split).difference(self.chunks)
        if new:
            self._learn(new)
        return [b"".join(map(self.chunks.__getitem__, chunks)) for chunks in split]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int, with_ids: bool, at_once: int = 128) -> Iterator[pa.RecordBatch]:
    tokenizer = _TOKENIZERS.setdefault(path, None) or WordTokenizer(path)
    _TOKENIZERS[path] = tokenizer
    end = np.array([end_id], dtype="<u4").tobytes()
    for b in batches:
        for at in range(0, b.num_rows, at_once):
            part = b.slice(at, at_once)
            rows = []
            for doc, ids in zip(part.column(0).to_pylist(), tokenizer.encode(part.column(1).to_pylist()), strict=True):
                ids += end
                for piece, k in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[k : k + 4 * capacity]
                    rows.append((doc, piece, k // 4, len(cut) // 4, zlib.crc32(cut), cut))
            cols = list(zip(*rows, strict=True))
            arrays = [pa.array(c, t) for c, t in zip(cols[:5], (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(cols[5], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Documents' token ids, each document's followed by end_id and cut into pieces of ``capacity``; the last piece may be shorter.

    Returns doc_id, piece, start, length, ids_crc32 and, if asked for, ids (little-endian unsigned 32-bit). A null
    text is empty: its one piece is end_id. Every row of docs gives its own pieces; an empty table gives none.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return through_arrow(rows, partial(_pieces, path=tokenizer_path, capacity=capacity, end_id=end_id, with_ids=with_ids), schema)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination (length: times) of the counted lengths with the largest sum of at most ``room``; of equal sums one that prefers longer lengths.

    Subset sums are bits of one integer: taking up to c of a length shifts it in binary steps. The lengths go from
    long to short and it stops as soon as the room can be filled.
    """
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= room and counts[x] > 0), reverse=True):
        steps.append((length, reach))
        left, take = min(counts[length], room // length), 1
        while left > 0:
            use = min(take, left)
            reach |= (reach << (length * use)) & mask
            left -= use
            take *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        times = 0
        while not before >> total & 1:
            total -= length
            times += 1
        if times:
            chosen[length] = times
    return chosen


def slack_plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """How to fill bins: (how many bins, {length: pieces of it in each}), by minimum bin slack.

    Each bin takes the longest length left and then the fullest combination that fits beside it. The same bin is
    repeated while the counts allow, so the plan is as long as there are different bins, not bins: a repetition
    ends when a length has fewer pieces left than one more bin would take.
    """
    left = {length: n for length, n in histogram.items() if n > 0}
    plan = []
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = fullest(left, capacity - longest) if longest < capacity else {}
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[length] // n for length, n in chosen.items())
        plan.append((times, chosen))
        for length, n in chosen.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
    return plan


def _places(plan: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first bin, pieces a bin, offset of the first) in the order of ranks."""
    out: dict[int, list] = {}
    ranks: dict[int, int] = {}
    bins = 0
    for times, chosen in plan:
        offset = 0
        for length in sorted(chosen, reverse=True):
            n = chosen[length]
            out.setdefault(length, []).append((ranks.get(length, 0), bins, n, offset))
            ranks[length] = ranks.get(length, 0) + n * times
            offset += n * length
        bins += times
    return {length: np.array(rows, dtype=np.int64) for length, rows in out.items()}


def _placed(batches: Iterator[pa.RecordBatch], places: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lengths, ranks = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            rows = places[int(length)]
            row = rows[np.searchsorted(rows[:, 0], ranks[at], side="right") - 1]
            nth = ranks[at] - row[:, 0]
            sequence[at] = row[:, 1] + nth // row[:, 2]
            offset[at] = row[:, 3] + nth % row[:, 2] * length
        keep = [c for c in b.schema.names if c != "_rank"]
        yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in keep), pa.array(sequence), pa.array(offset)], [*keep, "sequence_id", "offset"])


def pack_pieces(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length, ..., at most ``capacity`` long).

    Only the histogram of lengths, at most ``capacity`` rows, goes to the driver; the plan made of it says which
    ranks of a length go to which bins. A piece's rank among those of its length is numbered in salted buckets, so
    a length that very many pieces share isn't gathered in one task. pieces must be deterministic (a saved table).
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = _places(slack_plan(histogram, capacity))
    ranked = number_rows(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "_rank", salts_for(max(histogram.values(), default=0), 1))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema] + ["sequence_id long", "offset long"]
    return through_arrow(ranked.select(*pieces.columns, "_rank"), partial(_placed, places=places), ", ".join(fields))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Whole documents into as few sequences of at most ``capacity`` tokens as minimum bin slack finds.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Nulls, repeated rows and
    empty tables: as in token_pieces; other columns are left aside, whatever their names.
    """
    return pack_pieces(save(token_pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id), "pack-pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids) from packed pieces that bear ids: each sequence's ids in order, at most one sequence's capacity a group."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("length"))
    joined = F.aggregate("p", F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    return parts.select("sequence_id", "length", joined.alias("ids"))
