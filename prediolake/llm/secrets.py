"""Secrets in texts: three fixed patterns, and runs of characters that a battery of randomness tests tells from writing."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save, through_arrow

#: Fixed values of the contract: kinds in order, their patterns, and the least characters of the group that is counted.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}

#: Shortest run of characters that the battery looks at.
SHORTEST = 16
#: Least numbers of characters of the length classes; each class of each encoding has a threshold of its own.
LENGTHS = (16, 20, 24, 32, 48, 96)
#: Share of false discoveries, and the level at which a run is not random in its encoding any more.
FALSE_SHARE, UNFIT = 0.01, 0.001

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BOTH = "".join(c + c.lower() for c in _UPPER)
#: Encodings, narrowest first: that of a run is the first which has all its characters. A letter's two cases are neighbours, so capitals within a name don't look like chance to the tests of order.
ENCODINGS = {
    "decimal": _DIGITS, "hex": _DIGITS + "abcdef", "upper_hex": _DIGITS + "ABCDEF", "lower": _LOWER, "upper": _UPPER, "base32": _UPPER + "234567", "lower36": _DIGITS + _LOWER,
    "upper36": _DIGITS + _UPPER, "letters": _BOTH, "base62": _DIGITS + _BOTH, "base64": _BOTH + _DIGITS + "+/", "base64url": _BOTH + _DIGITS + "-_",
}
_SIGNS = "A-Za-z0-9+/_-"
_ASSIGN, _ACCESS, _HEX = re.compile(ASSIGN, re.IGNORECASE | re.ASCII), re.compile(ACCESS), re.compile(rf"(?<![0-9a-f])[0-9a-f]{{{LEAST['hex']},}}")
_RUN = re.compile(rf"(?<![{_SIGNS}])[{_SIGNS}]{{{SHORTEST},}}=*")
_PART = re.compile(rf"[A-Za-z0-9]{{{SHORTEST},}}")
_MAY = {"assign": "(?i)(?:password|passwd|secret|token|api_?key)[\"']? *[:=]", "run": rf"[{_SIGNS}]{{{SHORTEST},}}"}
_INDEX = {name: {c: k for k, c in enumerate(signs)} for name, signs in ENCODINGS.items()}
_SETS = {name: frozenset(signs) for name, signs in ENCODINGS.items()}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the fixed patterns' matches, ordered; a match is leftmost and whole, the next one of its kind begins after it, and one that is too short is dropped."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def encoding_of(run: str) -> str | None:
    """The narrowest encoding that has all characters of the run."""
    signs = set(run)
    return next((name for name, known in _SETS.items() if signs <= known), None)


def runs_of(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, encoding, characters to test) of the runs that the battery looks at. A run of no one encoding is looked at by its stretches of letters and digits; padding belongs to the span but isn't tested."""
    for m in _RUN.finditer(text):
        body = m[0].rstrip("=")
        name = encoding_of(body)
        if name:
            yield m.start(), m.end(), name, body
            continue
        for part in _PART.finditer(body):
            name = encoding_of(part[0])
            if name:
                yield m.start() + part.start(), m.start() + part.end(), name, part[0]


@dataclass(frozen=True)
class Writing:
    """What ordinary text looks like in an encoding: sums of squares and cubes of its characters' shares, how often neighbours lie in different halves of the alphabet, mean and variance of their serial products."""

    squares: float
    cubes: float
    switch: float
    serial: float
    spread: float


def _upper(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _cube_root_z(x: float, mean: float, variance: float) -> float:
    """Wilson and Hilferty's normal score of a chi-squared like x of that mean and variance."""
    v = 2 * mean * mean / variance if variance > 0 else 1e9
    return ((max(x, 0.0) / mean) ** (1 / 3) - (1 - 2 / (9 * v))) / math.sqrt(2 / (9 * v))


def _chi_moments(n: int, k: int, squares: float, cubes: float) -> tuple[float, float]:
    """Mean and variance of chi-squared against the even distribution, for n independent characters with such shares."""
    pairs = n * (n - 1) / 2
    mean = pairs * squares
    variance = pairs * (squares - squares**2) + 2 * pairs * (n - 2) * max(0.0, cubes - squares**2)
    return k + 2 * k * mean / n - n, (2 * k / n) ** 2 * variance


def _combined(ps: Sequence[float]) -> float:
    """One p-value of several that may depend on one another: the mean of their Cauchy scores."""
    score = sum(1 / math.tan(math.pi * min(max(p, 1e-300), 0.99)) for p in ps) / len(ps)
    return math.atan(1 / score) / math.pi if score > 0 else 0.5 - math.atan(score) / math.pi


def battery(run: str, encoding: str, writing: Writing) -> tuple[float, float]:
    """(p-value that the run is even and independent in its encoding, p-value that ordinary writing looks that random).

    Three tests: chi-squared of the counts, runs in the two halves of the alphabet, and serial correlation of
    neighbours. Each has two null hypotheses, and the moments under either depend on the length: from a short run
    nothing follows, so its second p-value is never small.
    """
    index = _INDEX[encoding]
    k, n = len(index), len(run)
    x = np.fromiter((index[c] for c in run), dtype=np.int64, count=n)
    counts = np.bincount(x, minlength=k).astype(float)
    chi = k / n * float(counts @ counts) - n
    even, text = _chi_moments(n, k, 1 / k, 1 / k**2), _chi_moments(n, k, writing.squares, writing.cubes)
    halves = x >= k // 2
    switches = int(np.count_nonzero(halves[1:] != halves[:-1]))
    y = x - (k - 1) / 2
    serial = float(y[1:] @ y[:-1]) / ((n - 1) * (k * k - 1) / 12)
    z_runs = (switches - (n - 1) / 2) / math.sqrt((n - 1) / 4)
    random = _combined((2 * _upper(abs(_cube_root_z(chi, *even))), 2 * _upper(abs(z_runs)), 2 * _upper(abs(serial) * math.sqrt(n - 1))))
    toward = lambda got, mean, deviation, aim: _upper((got - mean) / deviation * (1 if aim >= mean else -1))
    s = min(max(writing.switch, 0.02), 0.98)
    ordinary = _combined(
        (
            _upper(-_cube_root_z(chi, *text)) if text[0] > even[0] else 0.5,
            toward(switches, (n - 1) * s, math.sqrt((n - 1) * s * (1 - s)), (n - 1) / 2),
            toward(serial, writing.serial, math.sqrt(max(writing.spread, 1e-6) / (n - 1)), 0.0),
        )
    )
    return random, ordinary


_CLASS = np.zeros(256, dtype=bool)
_CLASS[[ord(c) for c in _DIGITS + _LOWER + _UPPER + "+/_-"]] = True


def pair_counts(texts: pa.StringArray) -> np.ndarray:
    """How often each character follows each within runs shorter than SHORTEST: 128 by 128 counts."""
    data = texts.buffers()[2]
    counts = np.zeros(128 * 128, dtype=np.int64)
    if data is None or not len(texts):
        return counts
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    b = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    inside = np.zeros(len(b) + 2, dtype=bool)
    inside[1:-1] = _CLASS[b]
    joined = inside[1:-2] & inside[2:-1]  # a character and the next
    edges = offsets[1:-1] - offsets[0]
    joined[edges[(edges > 0) & (edges < len(b))] - 1] = False  # the next text
    bounds = np.flatnonzero(np.diff(np.concatenate(([0], joined.view(np.int8), [0]))))
    starts, ends = bounds[::2], bounds[1::2]
    for a, z in zip(starts[ends - starts >= SHORTEST - 1], ends[ends - starts >= SHORTEST - 1], strict=True):
        joined[a:z] = False
    at = np.flatnonzero(joined)
    return np.bincount(b[at].astype(np.int64) * 128 + b[at + 1], minlength=128 * 128)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(128 * 128, dtype=np.int64)
    for b in batches:
        total += pair_counts(b.column(0).cast(pa.string()).fill_null(""))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["pair", "n"])


def writing_of(counts: np.ndarray) -> dict[str, Writing]:
    """What ordinary text looks like in each encoding, from the corpus' pairs of neighbours. Without any pairs: evenly spread characters, from which nothing can be told apart."""
    table = counts.reshape(128, 128).astype(float)
    out = {}
    for name, signs in ENCODINGS.items():
        codes, k = [ord(c) for c in signs], len(signs)
        part = table[np.ix_(codes, codes)]
        part = part / part.sum() if part.sum() else np.full((k, k), 1 / k**2)
        q, y = part.sum(axis=1), np.arange(k) - (k - 1) / 2
        product, upper = np.outer(y, y) * 12 / (k * k - 1), np.arange(k) >= k // 2
        mean = float((part * product).sum())
        out[name] = Writing(float((q**2).sum()), float((q**3).sum()), float(part[np.ix_(upper, ~upper)].sum() + part[np.ix_(~upper, upper)].sum()), mean, float((part * (product - mean) ** 2).sum()))
    return out


#: Tenths of powers of ten that p-values are rounded up to; more than these aren't told apart.
_MOST_TENTHS = 2_000
_NAMES = tuple(ENCODINGS)
_BASE = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("stratum", pa.int32()), ("tenths", pa.int32()), ("run", pa.int64()), ("fits", pa.bool_())]))


def _tested(text: str, writing: dict[str, Writing]) -> list[dict]:
    out = []
    for start, end, name, body in runs_of(text):
        random, ordinary = battery(body, name, writing[name])
        length = sum(len(body) >= x for x in LENGTHS) - 1
        tenths = min(_MOST_TENTHS, int(-10 * math.log10(max(ordinary, 1e-300))))
        out.append({"start": start, "end": end, "stratum": _NAMES.index(name) * len(LENGTHS) + length, "tenths": tenths, "run": xxhash.xxh64_intdigest(body) - (1 << 63), "fits": random >= UNFIT})
    return out


def _scanned(batches: Iterator[pa.RecordBatch], writing: dict[str, Writing]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column(b.num_columns - 1).cast(pa.string()).fill_null("")
        may = pc.or_(pc.match_substring_regex(texts, _MAY["assign"]), pc.match_substring_regex(texts, _MAY["run"])).to_pylist()
        base, runs = [], []
        for k, on in enumerate(may):
            text = texts[k].as_py() if on else ""
            base.append([{"start": a, "kind": kind, "end": z} for a, kind, z in base_spans(text)])
            runs.append(_tested(text, writing))
        yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(b.num_columns - 1)), pa.array(base, _BASE), pa.array(runs, _RUNS)], [*b.schema.names[:-1], "base", "runs"])


def thresholds(counts: Sequence[tuple[int, int, int]], share: float = FALSE_SHARE) -> dict[int, int]:
    """For each stratum the least tenths that are a discovery, by Benjamini and Hochberg; strata without discoveries are absent. counts: (stratum, tenths, different runs)."""
    out = {}
    for stratum in {s for s, _, _ in counts}:
        own = sorted(((t, n) for s, t, n in counts if s == stratum), reverse=True)
        total, above = sum(n for _, n in own), 0
        for tenths, n in own:
            above += n
            if total * 10 ** (-tenths / 10) <= share * above:
                out[stratum] = tenths
    return out


def _joined(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) for each row of docs.

    A span is the whole match, in code points, its end exclusive: ``kind:start:end``, by start, then kind as listed in
    KINDS. Spans of kind ``random`` overlap no other kind's; they are runs that fit an even, independent draw from
    their encoding and that ordinary writing doesn't look like. What ordinary writing looks like comes from all texts;
    each (encoding, length class) has its own threshold, at which by estimate one different run in a hundred is found
    wrongly. A run counts once for it however often it stands in the corpus.

    Null and empty texts have no spans (base_sha256 is that of the empty string). Rows of a null or repeated id are
    rows like others; repeated rows give repeated rows; columns not named are left aside, whatever their names. No
    rows: none. Texts are read twice and never shuffled; what goes to the driver are at most 16,384 pair counts and,
    for at most 72 strata, 2,001 counts each.
    """
    text = F.col(text_col).cast("string").alias("_text")
    pairs = through_arrow(docs.select(text), _counted, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(128 * 128, dtype=np.int64)
    counts[[r.pair for r in pairs]] = [r.n for r in pairs]
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, base array<struct<start:long,kind:int,end:long>>, runs array<struct<start:long,end:long,stratum:int,tenths:int,run:long,fits:boolean>>"
    scanned = save(through_arrow(docs.select(id_col, text), partial(_scanned, writing=writing_of(counts)), schema), "secrets")
    seen = scanned.select(F.explode("runs").alias("r")).select("r.stratum", "r.tenths", "r.run").distinct().groupBy("stratum", "tenths").agg(F.count(F.lit(1)).alias("n")).collect()
    least = thresholds([(r.stratum, r.tenths, r.n) for r in seen])
    limits = F.create_map(*(F.lit(x) for pair in sorted(least.items()) for x in pair)) if least else F.expr("map(-1, 0)")
    clear = lambda r: ~F.exists("base", lambda s: (s["start"] < r["end"]) & (r["start"] < s["end"]))
    found = F.filter("runs", lambda r: r["fits"] & F.coalesce(r["tenths"] >= F.try_element_at(limits, r["stratum"]), F.lit(False)) & clear(r))
    added = F.transform(found, lambda r: F.struct(r["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), r["end"].alias("end")))
    of = lambda n: F.size(F.filter("base", lambda s: s["kind"] == n)).cast("long")
    return scanned.select(F.col(f"`{id_col}`"), *(of(n).alias(f"n_{k}") for n, k in enumerate(KINDS[:3])), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.concat("base", added)).alias("spans"))
