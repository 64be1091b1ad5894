"""Chroma audio fingerprints: recordings aligned by offset histograms and bit errors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save, through_arrow

RATE, FRAME, HOP = 5512, 2048, 689
CLASSES = 12
#: Frames that the widest filter spans: so many frames make one packed integer.
SPAN = 16


def _filters() -> list[tuple[int, int, int, int]]:
    """(shape, first pitch class, classes, frames) of 16 filters: shapes in turn, other sizes for each."""
    return [(k % 6, (5 * k) % 9, 3 + k % 2, (4, 8, 12, 16)[(k // 2) % 4]) for k in range(16)]


#: The two bits of a filter's value: below -LEVEL, below 0, below LEVEL, above.
LEVEL = 0.12
_GRAY = np.array([0, 1, 3, 2], dtype=np.uint32)
#: Beginnings within a hop at which a recording is looked for, and the least certain bits of an integer that may differ.
PHASES, WEAK = 8, 3


def _pitch_classes() -> np.ndarray:
    """By bin of the spectrum: its pitch class, -1 outside 60 to 2600 Hz."""
    hertz = np.arange(FRAME // 2 + 1) * RATE / FRAME
    out = np.full(len(hertz), -1)
    heard = (hertz >= 60) & (hertz <= 2600)
    out[heard] = np.round(CLASSES * np.log2(hertz[heard] / 440.0)).astype(int) % CLASSES
    return out


_CLASS_OF = _pitch_classes()
_FOLD = np.stack([(_CLASS_OF == c).astype(np.float32) for c in range(CLASSES)], axis=1)
_WINDOW = np.hanning(FRAME).astype(np.float32)


def chroma(samples: np.ndarray) -> np.ndarray:
    """Frames x 12: the energy of each pitch class, scaled to length 1; silent frames are zero. Fewer samples than a frame: one padded frame; none: no frame."""
    if not len(samples):
        return np.zeros((0, CLASSES), np.float32)
    x = np.asarray(samples, dtype=np.float32)
    if len(x) < FRAME:
        x = np.pad(x, (0, FRAME - len(x)))
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    power = np.abs(np.fft.rfft(frames * _WINDOW, axis=1)).astype(np.float32) ** 2
    energy = power @ _FOLD
    norms = np.sqrt((energy * energy).sum(axis=1, keepdims=True))
    return np.divide(energy, norms, out=np.zeros_like(energy), where=norms > 1e-3)


def packed(frames: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(integers, margins, flips), a row for each run of SPAN frames: the packed integer of two bits from each of 16 filters, how far each filter's value is from the nearest level, and the bit that changes beyond it.

    A filter compares the sums of two parts of a rectangle of frames and classes; every sum is four reads of the
    integral image. Fewer frames than SPAN: the frames are padded with zeros to one run; no frames: nothing.
    """
    if not len(frames):
        return np.zeros(0, np.uint32), np.zeros((0, 16)), np.zeros((0, 16), np.uint32)
    if len(frames) < SPAN:
        frames = np.pad(frames, ((0, SPAN - len(frames)), (0, 0)))
    image = np.zeros((len(frames) + 1, CLASSES + 1))
    image[1:, 1:] = frames.cumsum(axis=0, dtype=np.float64).cumsum(axis=1)
    n = len(frames) - SPAN + 1

    def area(t0: int, t1: int, c0: int, c1: int) -> np.ndarray:
        return image[t1 : t1 + n, c1] - image[t0 : t0 + n, c1] - image[t1 : t1 + n, c0] + image[t0 : t0 + n, c0]

    out, margins, flips = np.zeros(n, np.uint32), np.zeros((n, 16)), np.zeros((n, 16), np.uint32)
    levels = np.array((-LEVEL, 0.0, LEVEL))
    for k, (shape, c, h, w) in enumerate(_filters()):
        whole = area(0, w, c, c + h)
        if shape == 0:
            part = area(0, w, 0, CLASSES) - whole
            a, b = whole * (CLASSES - h) / h, part
        elif shape == 1:
            a, b = area(0, w, c, c + h // 2) * (h - h // 2) / (h // 2), area(0, w, c + h // 2, c + h)
        elif shape == 2:
            a, b = area(0, w // 2, c, c + h), area(w // 2, w, c, c + h)
        elif shape == 3:
            a = area(0, w // 2, c, c + h // 2) + area(w // 2, w, c + h // 2, c + h)
            b = whole - a
        elif shape == 4:
            a = area(0, w, c + 1, c + 2) * (h - 1)
            b = whole - a / (h - 1)
        else:
            a = 2 * area(w // 4, w - w // 4, c, c + h) - whole + whole / 2
            b = whole / 2
        value = np.log1p(np.maximum(a, 0)) - np.log1p(np.maximum(b, 0))
        code = np.digitize(value, levels)
        out |= _GRAY[code] << np.uint32(2 * k)
        nearest = np.abs(value[:, None] - levels).argmin(axis=1)  # level j lies between codes j and j + 1
        margins[:, k] = np.abs(value - levels[nearest])
        flips[:, k] = (_GRAY[nearest] ^ _GRAY[nearest + 1]) << np.uint32(2 * k)
    return out, margins, flips


def pack(frames: np.ndarray) -> np.ndarray:
    """The packed integers alone."""
    return packed(frames)[0]


def asked(samples: np.ndarray) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """(integers, keys) of a recording that is looked for, at PHASES beginnings within a hop: cut anywhere, one of them lies within a PHASES-th of half a hop of the frames of what it was cut from.

    keys: for each integer, itself and what it is with each set of its WEAK least certain bits changed; 0 rows of them
    for silence, which tells nothing. So an integer is found again whatever has become of those bits.
    """
    out = []
    for phase in range(PHASES):
        frames = chroma(samples[phase * HOP // PHASES :])
        prints, margins, flips = packed(frames)
        weak = np.take_along_axis(flips, np.argsort(margins, axis=1, kind="stable")[:, :WEAK], axis=1)
        keys = np.repeat(prints[:, None], 1 << WEAK, axis=1)
        for change in range(1, 1 << WEAK):
            for bit in range(WEAK):
                if change >> bit & 1:
                    keys[:, change] ^= weak[:, bit]
        loud = frames.any(axis=1)
        heard = np.array([loud[t : t + SPAN].any() for t in range(len(prints))], dtype=bool)
        out.append((prints, [k if on else k[:0] for k, on in zip(keys, heard, strict=True)]))
    return out


def tones(vector: list[float | None] | None) -> np.ndarray:
    """A recording (16-bit samples at RATE) of a vector: each component sounds for HOP samples at a pitch that its value chooses from 24 half-tones, missing and non-finite ones are silent."""
    v = np.array([np.nan if x is None else x for x in vector or []], dtype=np.float64)
    if not len(v):
        return np.zeros(0, np.int16)
    good = np.isfinite(v)
    scale = np.sqrt(np.mean(v[good] ** 2)) if good.any() else 0.0
    pitch = np.clip(np.floor((np.where(good, v, 0.0) / (scale or 1.0) + 2.0) * 6), 0, 23)
    hertz = 220.0 * 2.0 ** (pitch / CLASSES)
    t = np.arange(HOP) / RATE
    wave = np.sin(2 * np.pi * hertz[:, None] * t) * np.where(good & (v != 0), 12000.0, 0.0)[:, None]
    return np.rint(wave).astype(np.int16).ravel()


def decode(audio: bytes | None) -> np.ndarray:
    """Little-endian 16-bit samples at RATE; an odd last byte is left out."""
    audio = audio or b""
    return np.frombuffer(audio[: len(audio) // 2 * 2], dtype="<i2")


def excerpt(vector: list[float | None] | None, hops: int = 40, noise: float = 0.1) -> np.ndarray:
    """A part of the vector's recording as a listener might have it: ``hops`` long, cut off the frames of the whole, with noise 20 dB below it. Where and which noise depends on the vector alone."""
    whole = tones(vector)
    rng = np.random.default_rng(crc32(whole.tobytes()))
    at = int(rng.integers(0, max(1, len(whole) - hops * HOP)))
    part = whole[at : at + hops * HOP].astype(np.float64)
    loud = np.sqrt(np.mean(part**2)) if len(part) else 0.0
    return np.clip(np.rint(part + rng.normal(size=len(part)) * noise * loud), -32768, 32767).astype(np.int16)


def _prints(batches: Iterator[pa.RecordBatch], samples: Callable[[object], np.ndarray]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            b = whole.slice(at, 1024)
            prints = [pack(chroma(samples(x))).astype("<u4") for x in b.column(1).to_pylist()]
            digests = np.array([xxhash.xxh64_intdigest(p.tobytes()) for p in prints], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digests), pa.array([p.view(np.int32).tolist() for p in prints], pa.list_(pa.int32()))], ["rec_id", "digest", "prints"])


def fingerprints(recordings: DataFrame, id_col: str = "rec_id", audio_col: str = "audio", samples: Callable[[object], np.ndarray] = decode) -> DataFrame:
    """(rec_id, digest, prints) for each recording: its packed integers and their hash.

    samples: makes samples at RATE of a value of the audio column; decode, by default, or tones where a table has
    vectors and no media. Null and empty audio have no samples, so no integers. Repeated rows give repeated rows;
    other columns are left aside; an empty table gives no rows.
    """
    rows = recordings.select(F.col(id_col).cast("long").alias("rec_id"), F.col(audio_col).alias("audio"))
    return through_arrow(rows, partial(_prints, samples=samples), "rec_id long, digest long, prints array<int>")


def _questions(batches: Iterator[pa.RecordBatch], samples: Callable[[object], np.ndarray]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 64):
            b = whole.slice(at, 64)
            rows = []
            for rec, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = asked(samples(x))
                digest = xxhash.xxh64(b"".join(p.astype("<u4").tobytes() + b"|" for p, _ in found)).intdigest()
                rows += [(rec, digest - (1 << 63), phase, p.view(np.int32).tolist(), [k.view(np.int32).tolist() for k in keys]) for phase, (p, keys) in enumerate(found) if len(p)]
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["rec_id", "digest", "phase", "prints", "keys"])


def questions(recordings: DataFrame, id_col: str = "rec_id", audio_col: str = "audio", samples: Callable[[object], np.ndarray] = decode, every: int = 50) -> DataFrame:
    """(rec_id, digest, phase, prints, keys) of the recordings that are looked for, those whose id is divisible by ``every``: a row for each beginning within a hop.

    samples as in fingerprints. Recordings without samples have no rows, neither have null ids; repeated rows ask again.
    """
    rows = recordings.select(F.col(id_col).cast("long").alias("rec_id"), F.col(audio_col).alias("audio")).filter(F.pmod("rec_id", F.lit(every)) == 0)
    return through_arrow(rows, partial(_questions, samples=samples), "rec_id long, digest long, phase int, prints array<int>, keys array<array<int>>")


def bit_errors(x: np.ndarray, y: np.ndarray, offset: int) -> tuple[int, float]:
    """(overlap in integers, share of differing bits there) where x begins ``offset`` integers into y; 1.0 without an overlap."""
    left, right = x[max(0, -offset) :], y[max(0, offset) :]
    n = min(len(left), len(right))
    return n, int(np.bitwise_count(left[:n] ^ right[:n]).sum()) / (32 * n) if n > 0 else 1.0


def _aligned(batches: Iterator[pa.RecordBatch], most_errors: float, least_overlap: int) -> Iterator[pa.RecordBatch]:
    """Bit errors of (question, class, phase, offset, votes, prints of both) at their offset; those beyond ``most_errors`` go."""
    for b in batches:
        q, c, phase, offset, votes, x, y = (b.column(k).to_pylist() for k in range(7))
        rows = []
        for k in range(b.num_rows):
            n, errors = bit_errors(np.array(x[k], np.int32).view(np.uint32), np.array(y[k], np.int32).view(np.uint32), offset[k])
            if n >= min(least_overlap, len(x[k]), len(y[k])) and errors <= most_errors:
                rows.append((q[k], c[k], phase[k], offset[k], votes[k], n, errors))
        cols = list(zip(*rows, strict=True)) or [()] * 7
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, kinds, strict=True)], ["q", "c", "phase", "offset", "votes", "overlap", "bit_error_rate"])


def align(prints: DataFrame, asking: DataFrame, least_votes: int = 2, offsets: int = 8, most_errors: float = 0.2, least_overlap: int = 8) -> DataFrame:
    """All recordings' classes, and where what is looked for stands in them.

    prints: from fingerprints; asking: from questions. Returns two kinds of rows. class: rec_id and the class of
    recordings with the same fingerprint (class_id, its smallest rec_id). match: a question (rec_id), a class
    (class_id), the offset of the question's first integer in the class's recording, how many integers voted for it,
    the overlap in integers, and the share of bits that differ there. Copies are one class, and questions with equal
    integers are asked once, so neither is paired with one another. A question finds its own class too.

    A question's integer votes, under each of its keys and at each phase, where a class has that integer at the
    beginning of a run of equal ones. Votes are counted by (question, class, phase, offset); the ``offsets`` with most
    of them, if at least ``least_votes``, are verified, and the one with fewest bit errors stays. Lost: what has no
    two integers in place with all but WEAK known bits equal (a test holds the recall on cut and noisy excerpts against
    all offsets), more than ``most_errors`` bit errors, and overlaps of under ``least_overlap`` integers that aren't
    all of either recording.

    Null ids are classes' members, never questions. Recordings without samples are one class and match nothing; so do
    silent stretches. No recordings: no rows; no questions: classes alone.
    """
    classes = save(prints.groupBy("digest").agg(F.min("rec_id").alias("class_id"), F.min("prints").alias("prints")), "chroma-classes")
    members = prints.select("rec_id", "digest").join(classes.select("digest", "class_id"), "digest").select("rec_id", "class_id")
    asking = save(asking, "chroma-questions")
    once = asking.groupBy("digest", "phase").agg(F.min("prints").alias("prints"), F.min("keys").alias("keys"))
    known = classes.select(F.col("digest").alias("c"), F.posexplode("prints").alias("pos", "value"), "prints").filter((F.col("pos") == 0) | (F.col("value") != F.element_at("prints", F.greatest("pos", F.lit(1))))).drop("prints")
    keyed = once.select(F.col("digest").alias("q"), "phase", F.posexplode("keys").alias("at", "values")).select("q", "phase", "at", F.explode(F.array_distinct("values")).alias("value"))
    counted = keyed.join(known, "value").groupBy("q", "c", "phase", (F.col("pos") - F.col("at")).alias("offset")).agg(F.count(F.lit(1)).alias("votes")).filter(F.col("votes") >= least_votes)
    ranked = counted.groupBy("q", "c").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("v"), "phase", "offset"))), 1, offsets).alias("best"))
    chosen = ranked.select("q", "c", F.explode("best").alias("b")).select("q", "c", "b.phase", "b.offset", (-F.col("b.v")).alias("votes"))
    sides = chosen.join(once.select(F.col("digest").alias("q"), "phase", F.col("prints").alias("x")), ["q", "phase"]).join(classes.select(F.col("digest").alias("c"), F.col("prints").alias("y")), "c")
    schema = "q long, c long, phase int, offset int, votes long, overlap int, bit_error_rate double"
    verified = through_arrow(sides.select("q", "c", "phase", "offset", "votes", "x", "y"), partial(_aligned, most_errors=most_errors, least_overlap=least_overlap), schema)
    fields = F.struct("bit_error_rate", "phase", "offset", "votes", "overlap")
    best = verified.groupBy("q", "c").agg(F.min(fields).alias("m")).join(classes.select(F.col("digest").alias("c"), "class_id"), "c")
    who = asking.select("rec_id", F.col("digest").alias("q")).distinct()
    matches = who.join(best, "q").select(F.lit("match").alias("kind"), "rec_id", "class_id", "m.offset", "m.votes", "m.overlap", "m.bit_error_rate")
    nothing = {"offset": "int", "votes": "long", "overlap": "int", "bit_error_rate": "double"}
    return members.select(F.lit("class").alias("kind"), "rec_id", "class_id", *(F.lit(None).cast(t).alias(c) for c, t in nothing.items())).union(matches)
