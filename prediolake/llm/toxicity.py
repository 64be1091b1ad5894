"""Toxic spans by a linear-chain conditional random field."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache, partial
from sys import intern

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import through_arrow

_WORD = re.compile(r"[^\W_]+")
#: Tokens to each side of a labelled one, in the sequences that the field is fitted to.
_AROUND = 6


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


@lru_cache(20_000)
def features(word: str) -> list[str]:
    """What the field sees of a token: the word, its beginnings of 4 to 6 letters and its ends of 2 and 3."""
    out = ["w=" + word]
    out += ["p=" + word[:k] for k in range(4, min(7, len(word)))]
    out += ["s=" + word[-k:] for k in (2, 3) if len(word) > k]
    return out


@dataclass
class Field:
    """Weights of a two-label chain (0: clean, 1: toxic) and of the document's score.

    emission: a feature's weight for label 1; bias: that of every token; transition: [from, to]; document: the
    logistic weights of (1, log of the expected toxic tokens, log-odds of the largest marginal).
    """

    emission: dict[str, float] = field(default_factory=dict)
    bias: float = -6.0
    transition: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    document: tuple[float, float, float] = (-4.0, 0.0, 0.0)

    def score(self, word: str) -> float:
        get = self.emission.get
        return self.bias + sum(get(f, 0.0) for f in features(word))


def marginals(emissions: Sequence[np.ndarray], transition: np.ndarray, cells: int = 500_000) -> list[np.ndarray]:
    """The probability of label 1 at each place of each chain, by the forward and backward recursions.

    emissions: by chain, the places' scores of label 1 (label 0 has 0). The recursions carry the odds of the two
    labels' forward (backward) sums, which stay in bounds however long a chain is. Chains of like length go
    together, at most ``cells`` padded places at a time, so memory doesn't grow with the table.
    """
    out: list[np.ndarray] = [np.zeros(0)] * len(emissions)
    order = sorted((k for k in range(len(emissions)) if len(emissions[k])), key=lambda k: len(emissions[k]))
    (t00, t01), (t10, t11) = np.exp(transition)
    at = 0
    while at < len(order):
        stop, shortest = at + 1, len(emissions[order[at]])
        while stop < len(order) and len(emissions[order[stop]]) <= 1.5 * shortest + 20 and (stop + 1 - at) * len(emissions[order[stop]]) <= cells:
            stop += 1
        part, longest = order[at:stop], len(emissions[order[stop - 1]])
        at = stop
        e = np.ones((longest, len(part)))
        lengths = np.array([len(emissions[k]) for k in part])
        for col, k in enumerate(part):
            e[: lengths[col], col] = np.exp(np.clip(emissions[k], -40, 40))
        forward, backward = e.copy(), np.ones_like(e)
        f = forward[0]
        for t in range(1, longest):
            below = t10 * f
            below += t00
            above = t11 * f
            above += t01
            above /= below
            forward[t] *= above
            f = forward[t]
        ends = np.bincount(lengths - 1, minlength=longest)
        b = backward[longest - 1]
        for t in range(longest - 2, -1, -1):
            x = b * e[t + 1]
            below = t01 * x
            below += t00
            x *= t11
            x += t10
            x /= below
            if ends[t]:
                x[lengths == t + 1] = 1.0
            backward[t] = b = x
        forward *= backward
        p = forward / (1.0 + forward)
        for col, k in enumerate(part):
            out[k] = p[: lengths[col], col]
    return out


def _tail(n: int, k: int, p: float) -> float:
    """Upper bound (Chernoff) of the log probability of k or more of n at chance p."""
    q = k / n
    if q <= p:
        return 0.0
    return -n * (q * math.log(q / p) + ((1 - q) * math.log((1 - q) / (1 - p)) if q < 1 else 0.0))


def label_tokens(docs: Sequence[tuple[list[str], int]], purity: float = 0.9) -> dict[str, bool]:
    """Features that mark toxic tokens: in toxic documents far beyond chance (over all features, chance 0.05) and at least ``purity`` of the time, at even odds of the labels.

    docs: (words, label). Only documents are labelled; this gives the tokens' labels. Chance is judged by documents,
    or by the different (word before, word after) that a feature of three toxic documents or more stands between.
    Copies of one document say the same thing once: their places are the same, and no more documents count than places.
    """
    toxic = sum(y for _, y in docs)
    clean = len(docs) - toxic
    if not toxic or not clean:
        return {}
    seen: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for words, y in docs:
        for f in {f for w in set(words) for f in features(w) if f[0] != "s"}:
            seen[f][y] += 1
    least = math.log(0.05 / max(1, len(seen)))

    def pure(n0: int, n1: int, all0: int, all1: int) -> bool:
        return n1 / all1 / (n1 / all1 + (n0 + 0.5) / all0) >= purity

    between: dict[str, tuple[set, set]] = {f: (set(), set()) for f, (n0, n1) in seen.items() if n1 >= 3 and pure(n0, n1, clean, toxic)}
    places = [0, 0]
    for words, y in docs:
        places[y] += len(words)
        for k, w in enumerate(words):
            for f in features(w):
                if f in between:
                    between[f][y].add((words[k - 1] if k else "", words[k + 1] if k + 1 < len(words) else ""))
    out = {}
    for f, (p0, p1) in between.items():
        n0, n1 = seen[f][0], min(seen[f][1], len(p1))
        by_document = n1 >= 3 and _tail(n0 + n1, n1, toxic / len(docs)) <= least and pure(n0, n1, clean, toxic)
        by_place = n1 >= 3 and pure(len(p0), len(p1), *places) and _tail(len(p0) + len(p1), len(p1), places[1] / sum(places)) <= least
        if by_document or by_place:
            out[f] = True
    return out


def _windows(words: list[str], marks: Sequence[int], toxic: int, rng: np.random.Generator) -> Iterator[tuple[int, int]]:
    """Stretches of a document to fit the field to: around each marked token, and some at random."""
    n, last = len(words), 0
    for k, m in enumerate(marks):
        if m and k >= last:
            last = min(n, k + _AROUND + 1)
            yield max(0, k - _AROUND), last
    for _ in range(1 if toxic else 3):
        if n:
            a = int(rng.integers(0, max(1, n - 2 * _AROUND)))
            if not any(marks[a : a + 2 * _AROUND]) or not toxic:
                yield a, min(n, a + 2 * _AROUND)


def fit(docs: Iterable[tuple[str | None, int]], rounds: int = 40, ridge: float = 0.5, seed: int = 7) -> Field:
    """Fit the field to labelled documents (text, 0 or 1), which are held in memory: pass a bounded sample.

    Tokens are labelled by label_tokens, the field is fitted to stretches around the labelled tokens and others at
    random, then twice more with the clean tokens that it took for toxic. The marginals of the same documents give
    the logistic weights of the document's score. Without documents of both labels, every text scores low.
    """
    held = [([intern(w) for w in words_of(x)], y) for x, y in docs]
    marks = label_tokens(held)
    if not marks:
        return Field()
    known: dict[str, bool] = {}

    def mark(w: str) -> bool:
        if w not in known:
            known[w] = any(f in marks for f in features(w) if f[0] != "s")
        return known[w]

    rng = np.random.default_rng(seed)
    tags = [bytes(int(y and mark(w)) for w in words) for words, y in held]
    chains: list[tuple[list[str], Sequence[int]]] = []
    for (words, y), t in zip(held, tags, strict=True):
        chains += [(words[a:b], t[a:b]) for a, b in _windows(words, t, y, rng)]
    model = _ascend(chains, marks, rounds, ridge)
    cache: dict[str, float] = {}
    for _ in range(2):  # clean tokens that it takes for toxic join the sequences, and it is fitted anew
        found = marginals([_emissions(words, model, cache) for words, _ in held], model.transition)
        for (words, y), t, p in zip(held, tags, found, strict=True):
            if not y:
                last = 0
                for k in np.flatnonzero(p >= 0.05).tolist():
                    if k >= last:
                        last = k + 3
                        chains.append((words[max(0, k - 2) : last], t[max(0, k - 2) : last]))
        model = _ascend(chains, marks, rounds, ridge)
        cache = {}
    found = marginals([_emissions(w, model, cache) for w, _ in held], model.transition)
    model.document = _logistic(np.array([_summary(p) for p in found]), np.array([y for _, y in held], dtype=float))
    return model


def _ascend(chains: list[tuple[list[str], Sequence[int]]], marks: dict[str, bool], rounds: int, ridge: float) -> Field:
    """The field of largest ridge likelihood of (words, labels) sequences, approached by gradient steps whose size is adapted to each weight."""
    names: dict[str, int] = {}
    seen = Counter(f for w in {w for words, _ in chains for w in words} for f in features(w))
    vocabulary: dict[str, list[int]] = {}
    for words, _ in chains:
        for w in words:
            if w not in vocabulary:
                vocabulary[w] = [names.setdefault(f, len(names)) for f in features(w) if seen[f] > 1 or f in marks]
    ids = {w: k for k, w in enumerate(vocabulary)}
    flat = np.array([k for v in vocabulary.values() for k in v], dtype=np.int64)
    owner = np.repeat(np.arange(len(vocabulary)), [len(v) for v in vocabulary.values()])
    longest = max(len(w) for w, _ in chains)
    grid, tag, real = (np.zeros((longest, len(chains)), dtype=t) for t in (np.int64, np.int64, bool))
    for col, (words, tags) in enumerate(chains):
        grid[: len(words), col] = [ids[w] for w in words]
        tag[: len(words), col] = list(tags)
        real[: len(words), col] = True
    weights, bias, trans = np.zeros(len(names)), -3.0, np.zeros((2, 2))
    squares = [np.full(len(names), 1e-8), 1e-8, np.full((2, 2), 1e-8)]
    gold = np.zeros((2, 2))
    both = real[1:] & real[:-1]
    np.add.at(gold, (tag[:-1][both], tag[1:][both]), 1)
    hits = np.bincount(grid[real], tag[real].astype(float), len(ids))
    for _ in range(rounds):
        by_word = np.bincount(owner, weights[flat], len(ids)) + bias
        e = np.where(real, by_word[grid], 0.0)
        p, pairs = _expected(e, real, trans)
        lift = hits - np.bincount(grid[real], p[real], len(ids))
        gradients = [np.bincount(flat, lift[owner], len(names)) - ridge * weights, float(lift.sum()), gold - pairs - ridge * trans]
        for k, g in enumerate(gradients):
            squares[k] = squares[k] + g * g
        weights = weights + 0.5 * gradients[0] / np.sqrt(squares[0])
        bias = bias + 0.5 * gradients[1] / math.sqrt(squares[1])
        trans = trans + 0.5 * gradients[2] / np.sqrt(squares[2])
    return Field({f: float(weights[k]) for f, k in names.items() if abs(weights[k]) > 1e-3}, float(bias), trans)


def _expected(e: np.ndarray, real: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of label 1 and the expected transitions of padded chains, by forward-backward in log space."""
    steps, n = e.shape
    alpha, beta = np.zeros((steps, 2, n)), np.zeros((steps, 2, n))
    alpha[0, 1] = e[0]
    for t in range(1, steps):
        a = alpha[t - 1]
        new = np.stack([np.logaddexp(a[0] + trans[0, 0], a[1] + trans[1, 0]), np.logaddexp(a[0] + trans[0, 1], a[1] + trans[1, 1]) + e[t]])
        alpha[t] = np.where(real[t], new, a)
    for t in range(steps - 2, -1, -1):
        b = beta[t + 1]
        new = np.stack([np.logaddexp(trans[0, 0] + b[0], trans[0, 1] + e[t + 1] + b[1]), np.logaddexp(trans[1, 0] + b[0], trans[1, 1] + e[t + 1] + b[1])])
        beta[t] = np.where(real[t + 1], new, 0.0)
    z = np.logaddexp(alpha[-1, 0], alpha[-1, 1])
    p = np.where(real, np.exp(np.minimum(0.0, alpha[:, 1] + beta[:, 1] - z)), 0.0)
    pairs = np.zeros((2, 2))
    both = real[1:] & real[:-1]
    for i in range(2):
        for j in range(2):
            x = alpha[:-1, i] + trans[i, j] + (e[1:] if j else 0.0) + beta[1:, j] - z
            pairs[i, j] = np.exp(np.minimum(0.0, x))[both].sum()
    return p, pairs


def _summary(p: np.ndarray) -> tuple[float, float, float]:
    if not len(p):
        return 1.0, 0.0, 0.0
    top = min(max(float(p.max()), 1e-4), 1 - 1e-4)
    return 1.0, math.log1p(float(p[p > 1e-3].sum())), math.log(top / (1 - top)) + math.log(1e4)


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1.0) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (y - p) - ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


class _Cache(dict):
    def __init__(self, model: Field):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) > 200_000:
            self.clear()
        s = self[word] = self.model.score(word)
        return s


def _emissions(words: list[str], model: Field, cache: dict[str, float]) -> np.ndarray:
    if not isinstance(cache, _Cache):
        for w in set(words):
            if w not in cache:
                cache[w] = model.score(w)
    return np.fromiter(map(cache.__getitem__, words), dtype=float, count=len(words))


def score_texts(texts: Sequence[str | None], model: Field, cache: dict[str, float] | None = None, spans: bool = True) -> list[tuple[float, list[tuple[int, int, float]]]]:
    """(score, spans) of each text: the document's score, and (start, end, largest marginal) of each run of tokens of marginal 0.5 or more, in code points of the text."""
    cache = _Cache(model) if cache is None else cache
    lowered = [(x or "").lower() for x in texts]
    found = marginals([_emissions(_WORD.findall(x), model, cache) for x in lowered], model.transition)
    w = np.array(model.document)
    out = []
    for text, low, p in zip(texts, lowered, found, strict=True):
        z = float(np.dot(w, _summary(p)))
        runs: list[tuple[int, int, float]] = []
        if spans and len(p) and p.max() >= 0.5:
            at = _places(text or "", low)
            before = -2
            for k in np.flatnonzero(p >= 0.5).tolist():
                if k == before + 1:
                    runs[-1] = (runs[-1][0], at[k][1], max(runs[-1][2], float(p[k])))
                else:
                    runs.append((*at[k], float(p[k])))
                before = k
        out.append((1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), runs))
    return out


def _places(text: str, low: str) -> list[tuple[int, int]]:
    """The tokens' (start, end) in the text; where lower-casing made it longer, each place is mapped back."""
    spans = [m.span() for m in _WORD.finditer(low)]
    if len(text) == len(low):
        return spans
    back = [k for k, c in enumerate(text) for _ in c.lower()]
    return [(back[a], back[b - 1] + 1) for a, b in spans]


def _scored(batches: Iterator[pa.RecordBatch], model: Field, keep_below: float | None, text_at: str, at_once: int = 2048) -> Iterator[pa.RecordBatch]:
    cache = _Cache(model)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    for whole in batches:
        for k in range(0, whole.num_rows, at_once):
            b = whole.slice(k, at_once)
            t = b.schema.get_field_index(text_at)
            found = score_texts(b.column(t).to_pylist(), model, cache, keep_below is None)
            if keep_below is not None:
                yield b.filter(pa.array([s < keep_below for s, _ in found]))
                continue
            rest = [i for i in range(b.num_columns) if i != t]
            spans = pa.array([[{"start": x, "end": y, "score": z} for x, y, z in runs] for _, runs in found], kind)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in rest), pa.array([s for s, _ in found], pa.float64()), spans], [*(b.schema.names[i] for i in rest), "score", "spans"])


def held_out(id_col: str | Column, folds: int = 5) -> Column:
    """Whether crc32 of the id as text is a multiple of ``folds``; null ids: false."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = 1200) -> list[tuple[str | None, int]]:
    """At most ``most`` toxic and 2 * ``most`` clean labelled documents outside the held-out fold, for the classifier alone: those with the smallest hashes of the id.

    Null labels, ids and conflicting labels of one id are left out; a document with several rows counts once.
    """
    chosen = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_y")).filter("_id IS NOT NULL AND _y IN (0, 1)")
    chosen = chosen.filter(~held_out("_id")).groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_z")).filter("_y = _z").withColumn("_h", F.xxhash64("_id"))
    parts = [chosen.filter(F.col("_y") == y).orderBy("_h", "_id").limit(n).select("_id", "_y") for y, n in ((1, most), (0, 2 * most))]
    few = F.broadcast(parts[0].union(parts[1]))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_t")).join(few, "_id")
    found = rows.groupBy("_id", "_y").agg(F.min("_t").alias("_t")).orderBy("_id").collect()
    return [(r["_t"], r["_y"]) for r in found]


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = 1200) -> DataFrame:
    """doc_id, held_out, score, predicted and spans (start, end, score in code points) for each row of docs.

    The text is all that a score sees. Null and empty texts score as texts without tokens, low. Repeated rows get
    the same score; other columns are left aside. Without labels of both kinds nothing is predicted toxic; an empty
    table gives no rows.
    """
    model = fit(labelled_sample(docs, labels, id_col, text_col, label_col, most))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("held_out", held_out("doc_id"))
    scored = through_arrow(rows, partial(_scored, model=model, keep_below=None, text_at="text"), "doc_id long, held_out boolean, score double, spans array<struct<start:int,end:int,score:double>>")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = 0.5, most: int = 1200) -> DataFrame:
    """The rows of docs, all columns, whose score is below ``threshold``; nulls as in score_documents."""
    model = fit(labelled_sample(docs, labels, id_col, text_col, label_col, most))
    return through_arrow(docs, partial(_scored, model=model, keep_below=threshold, text_at=text_col), docs.schema)
