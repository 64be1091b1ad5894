"""Language-model scores by the likelihood of subword lattices."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save, through_arrow

LOG10 = math.log(10)
_START = "▁"
_BASE = 0x9E3779B97F4A7C15
#: Words of one length that are fewer go one by one, in blocks of so many signs, their sums scaled after so many.
_FEW, _BLOCK, _SCALED = 8, 4096, 8


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: A-Z lower-cased, cut at the six ASCII white-space signs. Null: none."""
    return (text or b"").lower().split()


class Lattice:
    """The pieces of an existing vocabulary, and the likelihood of words over all ways to cut them.

    A word is a piece that begins a word, then pieces that don't, then a stop; each kind is a distribution. Signs
    that are no piece are spelled by their bytes, which are pieces of the second kind. ``weights`` has a piece's weight
    by its number in the vocabulary, stop the stop's; without, the vocabulary's own scores weigh: those of a merge list
    are ranks, taken as ranks of a Zipf distribution.
    """

    def __init__(self, path: str, weights: np.ndarray | None = None, stop: float = 1.0, smoothing: float = 0.1):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.bytes = np.zeros(256, np.int64)
        self.pieces: dict[str, int] = {}
        for k in range(self.size):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                self.bytes[int(piece[3:5], 16)] = k
            elif not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k)) and _START not in piece[1:]:
                self.pieces[piece] = k
        if weights is None:
            weights, smoothing = np.array([1.0 / (1.0 - min(0.0, model.get_score(k))) for k in range(self.size)]), 0.0
            stop = float(weights.sum()) / 3
        self.pieces.setdefault(_START, self.size)
        first = np.array([k for piece, k in self.pieces.items() if piece[0] == _START])
        later = np.array([*(k for piece, k in self.pieces.items() if piece[0] != _START), *self.bytes])
        held = np.append(np.asarray(weights, np.float64)[: self.size], 0.0 if _START in self.pieces and self.pieces[_START] < self.size else 1.0) + smoothing
        self.scores = np.full(self.size + 1, -np.inf)
        self.scores[first] = np.log(held[first] / held[first].sum())
        self.scores[later] = np.log(held[later] / (held[later].sum() + stop + smoothing))
        self.stop = float(np.log((stop + smoothing) / (held[later].sum() + stop + smoothing)))
        self.longest = max(map(len, self.pieces))
        keys = np.array([self._key(piece) for piece in self.pieces], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(list(self.pieces.values()))[order]
        self.maybe = np.zeros(1 << 22, bool)  # by a key's highest bits: whether any piece has them
        self.maybe[keys >> np.uint64(42)] = True

    @staticmethod
    def _key(piece: str) -> int:
        key = 0
        for c in piece:
            key = (key * _BASE + ord(c) + 1) % 2**64
        return key

    def _arcs(self, codes: np.ndarray, begins: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(numbers, scores, spelled) for words of one length, a row of code points each: [d-1, word, place] is the piece of d signs there, -1 and minus infinity where none is; spelled: places whose sign is spelled by bytes. begins: the rows are words from their first sign on."""
        b, n = codes.shape
        width = min(self.longest, n)
        numbers, scores = np.full((width, b, n), -1, np.int64), np.full((width, b, n), -np.inf)
        keys = np.zeros((b, n), np.uint64)
        for d in range(1, width + 1):
            keys = keys[:, : n - d + 1] * np.uint64(_BASE) + codes[:, d - 1 :] + np.uint64(1)
            row, place = np.nonzero(self.maybe[keys >> np.uint64(42)])
            asked = keys[row, place]
            at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
            hit = (self.keys[at] == asked) & ((place == 0) & begins | (codes[row, place] != ord(_START)))  # a piece that begins a word does so at its first place alone
            row, place, found = row[hit], place[hit], self.ids[at[hit]]
            numbers[d - 1, row, place] = found
            scores[d - 1, row, place] = self.scores[found]
        spelled = numbers[0] < 0
        for c in np.unique(codes[spelled]).tolist():
            scores[0][spelled & (codes == c)] = self.scores[self.bytes[list(chr(c).encode("utf-8", "surrogatepass"))]].sum()
        return numbers, scores, spelled

    @staticmethod
    def _sums(terms: np.ndarray) -> np.ndarray:
        top = terms.max(axis=0)
        return top + np.log(np.exp(terms - top).sum(axis=0))

    def _forward(self, scores: np.ndarray) -> np.ndarray:
        width, b, n = scores.shape
        forward, live = np.zeros((n + 1, b)), np.isfinite(scores).any(axis=1)
        for j in range(1, n + 1):
            d = np.arange(1, min(width, j) + 1)
            d = d[live[d - 1, j - d]]
            forward[j] = self._sums(forward[j - d] + scores[d - 1, :, j - d])
        return forward

    def _groups(self, words: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places in the list, code points) of words of one length, with the sign that begins a word; at most 40,000 signs at a time, or one word."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(words) else ():
            n = int(lengths[part[0]]) + 1
            step = max(1, 40_000 // n)
            for at in range(0, len(part), step):
                some = part[at : at + step]
                whole = "".join([_START + words[k] for k in some.tolist()])
                yield some, np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(some), n).astype(np.uint64)

    def _blocks(self, codes: np.ndarray, backward: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(first, last, places, lengths, numbers, scores, spelled) of the arcs of one word that begin at places first .. last - 1, a block at a time, by place; places count from first, and a number is -1 where a sign is spelled."""
        n = len(codes)
        starts = range(0, n, _BLOCK)
        for a in reversed(starts) if backward else starts:
            b = min(n, a + _BLOCK)
            numbers, scores, spelled = self._arcs(codes[None, a : min(n, b + self.longest - 1)], a == 0)
            place, d = np.nonzero(np.isfinite(scores[:, 0, : b - a]).T)
            yield a, b, place, d + 1, numbers[d, 0, place], scores[d, 0, place], np.flatnonzero(spelled[0, : b - a])

    def _streamed(self, codes: np.ndarray) -> np.ndarray:
        """The natural log of the forward sum at each place of one word, whatever its length: only the last sums, scaled again every few signs, are held beside the result."""
        n, width = len(codes), self.longest
        logs = np.full(n + 1, -np.inf)
        sums, scale = [1.0] + [0.0] * (width - 1), 0.0  # of the places at and after the next, as far as arcs have come
        for a, b, place, d, _, score, _ in self._blocks(codes):
            weight, to, bounds = np.exp(score).tolist(), (place + d).tolist(), np.searchsorted(place, np.arange(0, b - a + _SCALED, _SCALED)).tolist()
            begin = place.tolist()
            values, scales = [], []
            for c, at in enumerate(range(0, b - a, _SCALED)):
                held = min(_SCALED, b - a - at)
                g = sums + [0.0] * held
                for k in range(bounds[c], bounds[c + 1]):
                    g[to[k] - at] += g[begin[k] - at] * weight[k]
                values += g[:held]
                scales += [scale] * held
                sums = g[held : held + width]
                top = max(sums)
                if top > 0:
                    sums, scale = [x / top for x in sums], scale + math.log(top)
            with np.errstate(divide="ignore"):
                logs[a:b] = np.log(values) + scales
        logs[n] = (math.log(sums[0]) if sums[0] > 0 else -np.inf) + scale
        return logs

    def _streamed_expected(self, codes: np.ndarray, times: float, counts: np.ndarray) -> None:
        """Add the pieces expected in one word, seen ``times``, to counts: its arcs are made anew from its end, block by block."""
        forward, n, width = self._streamed(codes), len(codes), self.longest
        sums, scale = [1.0] + [0.0] * (width - 1), 0.0  # backward sums of the place after the next and those behind it
        after = np.full(width, -np.inf)  # logs of the same
        after[0] = 0.0
        for a, b, place, d, number, score, spelled in self._blocks(codes, backward=True):
            weight, length, bounds = np.exp(score).tolist(), d.tolist(), np.searchsorted(place, np.arange(b - a + 1)).tolist()
            values, scales = [0.0] * (b - a), [0.0] * (b - a)
            for done, at in enumerate(range(b - a - 1, -1, -1), 1):
                total = 0.0
                for k in range(bounds[at], bounds[at + 1]):
                    total += weight[k] * sums[length[k] - 1]
                values[at], scales[at] = total, scale
                sums.insert(0, total)
                sums.pop()
                if done % _SCALED == 0 or not at:
                    top = max(sums)
                    if top > 0:
                        sums, scale = [x / top for x in sums], scale + math.log(top)
            with np.errstate(divide="ignore"):
                backward = np.concatenate((np.log(values) + scales, after))
            share = np.exp(forward[a + place] + score + backward[place + d] - forward[n]) * times
            counts += np.bincount(number[number >= 0], share[number >= 0], self.size + 1)
            if len(spelled):
                own = number < 0
                signs = codes[a + place[own]]
                for c in np.unique(signs).tolist():
                    np.add.at(counts, self.bytes[list(chr(c).encode("utf-8", "surrogatepass"))], share[own][signs == c].sum())
            after = backward[:width]

    def likelihoods(self, words: Sequence[str]) -> np.ndarray:
        """The natural log of each word's probability, by the forward recursion in log space over every segmentation. Words of a length that few share, so all very long ones, go through it one by one, in blocks."""
        out = np.zeros(len(words))
        for some, codes in self._groups(words):
            if len(some) < _FEW:
                out[some] = [self._streamed(word)[-1] + self.stop for word in codes]
            else:
                out[some] = self._forward(self._arcs(codes)[1])[-1] + self.stop
        return out

    def expected(self, words: Sequence[str], times: np.ndarray) -> np.ndarray:
        """How often each piece is expected over all segmentations of the words, each seen ``times``, by the forward and backward recursions."""
        counts = np.zeros(self.size + 1)
        for some, codes in self._groups(words):
            if len(some) < _FEW:
                for word, n in zip(codes, times[some].tolist(), strict=True):
                    self._streamed_expected(word, n, counts)
                continue
            numbers, scores, spelled = self._arcs(codes)
            width, b, n = scores.shape
            forward, backward, live = self._forward(scores), np.zeros((n + 1, b)), np.isfinite(scores).any(axis=1)
            for i in range(n - 1, -1, -1):
                d = 1 + np.flatnonzero(live[: n - i, i])
                backward[i] = self._sums(backward[i + d] + scores[d - 1, :, i])
            for d in (1 + np.flatnonzero(live.any(axis=1))).tolist():
                share = np.exp(forward[: n - d + 1].T + scores[d - 1, :, : n - d + 1] + backward[d:].T - forward[n][:, None]) * times[some][:, None]
                real = numbers[d - 1, :, : n - d + 1]
                counts += np.bincount(real[real >= 0], share[real >= 0], self.size + 1)
                if d == 1 and spelled.any():
                    for c in np.unique(codes[spelled]).tolist():
                        np.add.at(counts, self.bytes[list(chr(c).encode("utf-8", "surrogatepass"))], share[spelled & (codes == c)].sum())
        return counts


def _counted(batches: Iterator[pa.RecordBatch], most: int = 250_000) -> Iterator[pa.RecordBatch]:
    """(word, n): how often each word occurs in the training texts; words of other texts come with 0. Sums of parts: the table is emptied beyond ``most`` words."""
    seen: Counter = Counter()
    others: set[bytes] = set()

    def pack() -> pa.RecordBatch:
        more = others.difference(seen)
        words = [*seen, *more]
        counts = np.concatenate([np.fromiter(seen.values(), np.int64, len(seen)), np.zeros(len(more), np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts)], ["word", "n"])

    for b in batches:
        for text, out in zip(b.column(0).cast(pa.binary()).to_pylist(), b.column(1).to_pylist(), strict=True):
            (others if out else seen).update(words_of(text))
            if len(seen) + len(others) > most:
                yield pack()
                seen.clear()
                others.clear()
    if seen or others:
        yield pack()


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 50_000, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in fewer batches, of about ``rows`` rows or ``most_bytes``: words of one length go through the recursions together."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= rows or sum(x.nbytes for x in held) >= most_bytes:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def _expected(batches: Iterator[pa.RecordBatch], path: str, weights: np.ndarray | None, stop: float) -> Iterator[pa.RecordBatch]:
    """(piece, n): the pieces expected in the words (word, times seen) of a task."""
    lattice = Lattice(path, weights, stop)
    counts = np.zeros(lattice.size + 1)
    for b in _gathered(batches):
        counts += lattice.expected(b.column(0).to_pylist(), b.column(1).to_numpy().astype(np.float64))
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["piece", "n"])


def trained(words: DataFrame, path: str, rounds: int = 4) -> tuple[np.ndarray | None, float]:
    """The pieces' weights and the stop's: expectation over the lattices of all words (word, n), each as often as it was seen, ``rounds`` times from the vocabulary's own scores on. What comes to the driver is a sum for each piece."""
    stops = float(words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    weights, stop = None, 1.0
    for _ in range(rounds if stops else 0):
        found = through_arrow(words.select("word", "n"), partial(_expected, path=path, weights=weights, stop=stop), "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        stop, weights = stops, np.zeros(sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size() + 1)
        for r in found:
            weights[r["piece"]] = r["n"]
    return weights, stop


def _weighed(batches: Iterator[pa.RecordBatch], path: str, weights: np.ndarray | None, stop: float, tokens: int, types: int, goes_on: float) -> Iterator[pa.RecordBatch]:
    lattice = Lattice(path, weights, stop)
    for b in _gathered(batches):
        counts = b.column(1).to_numpy()
        score = (lattice.likelihoods(b.column(0).to_pylist()) + goes_on) / LOG10
        base = np.log10((counts + 1.0) / (tokens + types + 1.0))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(base), pa.array(score)], ["word", "n", "base", "score"])


def _read(batches: Iterator[pa.RecordBatch], frequent: Broadcast) -> Iterator[pa.RecordBatch]:
    """By text: one row (row, doc_id, held_out, sums over frequent words) and a row (row, word, times) for each other word."""
    from pyspark import TaskContext

    words, values = frequent.value
    known, base, score = values
    index = dict(zip(words, range(len(words)), strict=True))
    at = TaskContext.get().partitionId() << 36
    names = ["row", "doc_id", "held_out", "word", "times", "known", "base", "score"]
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
    cols: list[list] = [[] for _ in names]

    def pack() -> pa.RecordBatch:
        arrays = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
        arrays[3] = arrays[3].cast(pa.string())
        for c in cols:
            c.clear()
        return pa.RecordBatch.from_arrays(arrays, names)

    for b in batches:
        for text, doc, out in zip(b.column(0).cast(pa.binary()).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            tokens = words_of(text)
            where = np.fromiter(map(index.get, tokens, repeat(-1)), np.int64, len(tokens))
            near = where[where >= 0]
            rare = Counter([tokens[k] for k in np.flatnonzero(where < 0).tolist()])
            at += 1
            row = (at, doc, out, None, len(tokens), int(known[near].sum()), float(base[near].sum()), float(score[near].sum()))
            for c, v in zip(cols, row, strict=True):
                c.append(v)
            n = len(rare)
            if n:
                for c, v in zip(cols, ([at] * n, [None] * n, [None] * n, list(rare), list(rare.values()), [None] * n, [None] * n, [None] * n), strict=True):
                    c.extend(v)
            if len(cols[0]) >= 100_000:
                yield pack()
    if cols[0]:
        yield pack()


def _frequent(words: DataFrame, most: int) -> DataFrame:
    """The words seen at least so often that they are at most ``most``: by a histogram of counts in sixteenths of an octave, so no task sorts them all."""
    level = F.when(F.col("n") > 0, F.floor(F.log2("n") * 16).cast("int")).otherwise(-1)
    levels = {r["level"]: r["words"] for r in words.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).collect()}
    total, least = 0, max(levels, default=-1) + 1
    for at in sorted(levels, reverse=True):
        total += levels[at]
        if total > most:
            break
        least = at
    return words.filter(level >= least)


def score_documents(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, fold: int = 2, most_frequent: int = 250_000) -> DataFrame:
    """Log10 probabilities of whole texts under a subword lattice, and under word counts with one added.

    The model is learned from the rows whose crc32 of the id as text, modulo ``folds``, isn't ``fold`` (null ids:
    learned from). A token is a word or the text's end, which has its share of the tokens (one more of each counted). A
    word's probability, seen or not, is that of its lattice: the sum over all its cuts into pieces of an existing
    vocabulary. The vocabulary's own scores weigh the cuts at first; then the pieces' scores are trained by expectation
    over the lattices of all words learned from, each as often as it stands there.

    Returns a row for each row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Null
    texts are empty: the end alone. Repeated rows count and are scored each; other columns are left aside. An empty
    table gives no rows.

    Words are counted over all texts. The most frequent words, at most ``most_frequent``, go to all tasks; the other
    words of each text are joined with the table of words by key and summed by text.
    """
    spark = docs.sparkSession
    out = F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))
    rows = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(id_col).cast("long").alias("doc_id"), out.alias("held_out"))
    counted = save(through_arrow(rows.select("text", "held_out"), _counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    ends = rows.filter(~F.col("held_out")).count()
    sums = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    tokens, types = sums[0] + ends, sums[1] + (ends > 0)
    end = (ends + 1) / (tokens + 2)
    weights, stop = trained(counted.filter("n > 0"), vocabulary_path)
    weigh = partial(_weighed, path=vocabulary_path, weights=weights, stop=stop, tokens=tokens, types=types, goes_on=math.log(1 - end))
    words = save(through_arrow(counted, weigh, "word string, n long, base double, score double"), "lm-words")
    top = _frequent(words, most_frequent).toArrow()
    frequent = spark.sparkContext.broadcast((top["word"].cast(pa.binary()).to_pylist(), ((top["n"].to_numpy() > 0).astype(np.int64), top["base"].to_numpy(), top["score"].to_numpy())))
    read = save(through_arrow(rows, partial(_read, frequent=frequent), "row long, doc_id long, held_out boolean, word string, times long, known long, base double, score double"), "lm-read")
    own = read.filter("word IS NULL")
    rest = read.filter("word IS NOT NULL").select("row", "word", "times").join(words, "word")
    times = F.col("times")
    rest = rest.select("row", F.when(F.col("n") > 0, times).otherwise(0).alias("known"), (F.col("base") * times).alias("base"), (F.col("score") * times).alias("score"))
    # one aggregation by text over both kinds of rows, in place of a join with the texts
    both = own.select("row", "doc_id", "held_out", "times", "known", "base", "score").unionByName(rest, allowMissingColumns=True)
    by_row = both.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("times").alias("times"), *(F.sum(c).alias(c) for c in ("known", "base", "score")))
    end_base, end_score = math.log10((ends + 1) / (tokens + types + 1)), math.log10(end)
    return by_row.select(
        "doc_id", "held_out", (F.col("times") + 1).alias("n_tokens"), (F.col("known") + int(ends > 0)).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + end_base).alias("base_score"), (F.col("score") + end_score).alias("score"),
    )
