"""Each operator against a plain version of itself, and over nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import inspect
import math
import os
import random
import time
import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from prediolake.llm import ann, chroma, common, html_text, lattice, mixing, packing, sharding, simhash, spans, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id string, shard int, fp string, node long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + ("." if k % 9 == 8 else "") for k in range(n))


TEXTS = [prose(1, 60), prose(1, 60), None, "", " \n\t ", "one two", prose(2, 40) + " extra", prose(3, 6000), "Á É ñ ß 日本  x", prose(4, 30)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, None if k == 3 else "en", None if k == 4 else "s", None, 0.9, "c", 3, "f", 1) for k, t in enumerate(TEXTS)]
    rows += [rows[0], (None, "no id here", "en", "s", 3, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- 1: toxicity ---


def toxic_corpus(n=240):
    r = random.Random(5)
    out = []
    for k in range(n):
        words = [r.choice(WORDS) + r.choice(("", "x", "yz", "on")) for _ in range(r.randint(5, 60))]
        bad = k % 4 == 0
        for _ in range(3 if bad else 0):
            words.insert(r.randrange(len(words) + 1), "vilify" + r.choice(("ing", "ed", "er", "", "s")))
        out.append((k, " ".join(words), int(bad)))
    return out


def test_field_finds_unseen_forms():
    corpus = toxic_corpus()
    model = toxicity.fit([(t, y) for k, t, y in corpus if k % 5])
    held = [(t, y) for k, t, y in corpus if k % 5 == 0] + [("quiet alpha Vilifyness beta VILIFYABLE gamma", 1)]
    found = toxicity.score_texts([t for t, _ in held], model)
    assert all((s >= 0.5) == bool(y) for (s, _), (_, y) in zip(found, held, strict=True))
    text = held[-1][0]
    assert [text[a:b] for a, b, _ in found[-1][1]] == ["Vilifyness", "VILIFYABLE"]


def test_marginals_are_the_sums_over_all_labellings():
    rng = np.random.default_rng(0)
    trans = rng.normal(size=(2, 2))
    chains = [rng.normal(size=n) for n in (1, 2, 5, 7, 7)] + [np.zeros(0)]
    for e, p in zip(chains, toxicity.marginals(chains, trans, cells=8), strict=True):
        total, on = 0.0, np.zeros(len(e))
        for y in product((0, 1), repeat=len(e)):
            w = math.exp(sum(e[k] for k in range(len(e)) if y[k]) + sum(trans[a, b] for a, b in zip(y, y[1:], strict=False)))
            total += w
            on += w * np.array(y)
        assert np.allclose(p, on / total)
    assert np.isfinite(toxicity.marginals([rng.normal(size=50_000) * 50], trans)[0]).all()


def test_toxicity_edges(spark, docs, empty):
    labels = spark.createDataFrame([(k, None if k == 5 else k % 2) for k in range(8)] + [(None, 1)], "doc_id long, toxic int")
    rows = toxicity.score_documents(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == 0 for r in rows)
    assert {r.doc_id: r.held_out for r in rows if r.doc_id is not None} == {k: zlib.crc32(str(k).encode()) % 5 == 0 for k in range(len(TEXTS))}
    assert toxicity.score_documents(empty, labels).count() == 0 and toxicity.score_documents(docs, labels.limit(0)).count() == docs.count()
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == docs.count()


# --- 2: mixing ---


def test_raking_meets_feasible_targets():
    cells = [(s, lang, t, n) for (s, lang, t), n in zip(product("ab", "xy", "pq"), (900, 50, 300, 80, 200, 40, 120, 60), strict=True)]
    y = np.array(mixing.rake_cells(cells, 0.3, rounds=200))
    have = np.array([c[3] for c in cells])
    assert (y <= have + 1e-9).all() and math.isclose(y.sum(), 0.3 * have.sum(), rel_tol=1e-6)
    for d in range(3):
        sums = {k: sum(n for c, n in zip(cells, have, strict=True) if c[d] == k) for k in {c[d] for c in cells}}
        whole = sum(v**0.7 for v in sums.values())
        for k, v in sums.items():
            assert math.isclose(sum(a for c, a in zip(cells, y, strict=True) if c[d] == k), 0.3 * have.sum() * v**0.7 / whole, rel_tol=1e-6)
    assert mixing.rake_cells([], 0.5) == []


def test_both_ways_of_raking_agree(spark):
    r = random.Random(3)
    rows = spark.createDataFrame([(k, r.choice("ab"), r.choice("xyz"), r.choice("pq"), r.randint(0, 90)) for k in range(80)], "doc_id long, source string, lang string, topic string, n_tokens long")
    for targets in (None, {"lang": {"x": 0.5, "y": 0.5}}):
        a, b = (mixing.calibrate(rows, rounds=3, targets=targets, most_cells=m).orderBy("doc_id").collect() for m in (100, 1))
        assert np.allclose([r.probability for r in a], [r.probability for r in b])


def test_mixing_edges(docs, empty):
    rows = mixing.mix(docs).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == docs.count() and by[3].lang == mixing.NONE and by[2].topic == "empty" and by[2].n_tokens == 0 and by[7].topic == "long"
    assert not by[None].kept and all(0 <= r.probability <= 1 for r in rows) and mixing.mix(empty).count() == 0


# --- 3: chroma ---


def heard(song, at, n, seed, noise=0.1):
    rng = np.random.default_rng(seed)
    part = song[at : at + n].astype(float)
    return np.clip(part + rng.normal(size=len(part)) * noise * np.sqrt(np.mean(part**2)), -32768, 32767).astype("<i2")


def test_excerpt_aligns(spark):
    rng = np.random.default_rng(2)
    songs = [chroma.tones((rng.normal(size=80) / 8).tolist()) for _ in range(6)]
    cut = heard(songs[3], chroma.HOP * 20 + 300, chroma.HOP * 40, 2)
    audio = [(k + 1, s.astype("<i2").tobytes()) for k, s in enumerate(songs)] + [(50, cut.tobytes()), (100, cut.tobytes() + b"\0"), (7, None), (8, b""), (150, bytes(4000)), (200, bytes(90_000)), (1, songs[0].astype("<i2").tobytes()), (None, b"")]
    table = spark.createDataFrame([(k, a, 1.0, 2, "p") for k, a in audio], "rec_id long, audio binary, votes double, phase int, prints string")
    rows = chroma.align(common.save(chroma.fingerprints(table), "t"), chroma.questions(table)).collect()
    classes = {r.rec_id: r.class_id for r in rows if r.kind == "class"}
    assert classes[100] == classes[50] == 50 and classes[8] == classes[7] == classes[None] == 7 and len([r for r in rows if r.kind == "class"]) == len(audio)
    matches = {(r.rec_id, r.class_id): r for r in rows if r.kind == "match"}
    assert set(matches) == {(50, 4), (100, 4), (50, 50), (100, 50)} and matches[50, 4].offset in (20, 21) and matches[50, 4].bit_error_rate < 0.15
    assert len([r for r in rows if r.kind == "match"]) == 4
    none = table.limit(0)
    assert chroma.align(common.save(chroma.fingerprints(none), "t"), chroma.questions(none)).count() == 0
    assert {r.kind for r in chroma.align(common.save(chroma.fingerprints(table), "t"), chroma.questions(none)).collect()} == {"class"}


@pytest.mark.parametrize("noise", [0.0, 0.1])
def test_recall_of_excerpts_cut_anywhere(spark, noise):
    """Against all offsets and phases of all pairs."""
    rng = np.random.default_rng(5)
    songs = [chroma.tones((rng.normal(size=64) / 8).tolist()) for _ in range(40)]
    cuts = [heard(s, int(rng.integers(0, len(s) - 35 * chroma.HOP)), 35 * chroma.HOP, k, noise) for k, s in enumerate(songs)]
    rows = [(k + 1, s.astype("<i2").tobytes()) for k, s in enumerate(songs)] + [(50 * (k + 10), c.tobytes()) for k, c in enumerate(cuts)]
    table = spark.createDataFrame(rows, "rec_id long, audio binary").repartition(4)
    found = {(r.rec_id, r.class_id) for r in chroma.align(common.save(chroma.fingerprints(table), "t"), chroma.questions(table)).collect() if r.kind == "match"}
    prints = {k: chroma.pack(chroma.chroma(chroma.decode(a))) for k, a in rows}
    plain = set()
    for k, cut in enumerate(cuts):
        for x, _ in chroma.asked(cut):
            for c, y in prints.items():
                for offset in range(8 - len(x), len(y) - 7):
                    n, errors = chroma.bit_errors(x, y, offset)
                    if n >= 8 and errors <= 0.2:
                        plain.add((50 * (k + 10), c))
    assert all((50 * (k + 10), k + 1) in plain for k in range(40))
    assert found <= plain and len(found) >= 0.9 * len(plain)
    assert sum((50 * (k + 10), k + 1) in found for k in range(40)) >= 38


def test_keys_hold_every_change_of_the_weakest_bits():
    song = chroma.tones((np.random.default_rng(1).normal(size=30) / 8).tolist())
    for prints, keys in chroma.asked(song)[:2]:
        for p, k in zip(prints, keys, strict=True):
            changed = np.bitwise_or.reduce(k ^ p)
            assert len(set(k.tolist())) == 1 << chroma.WEAK and k[0] == p and np.bitwise_count(changed) == chroma.WEAK
    assert all(len(k) == 0 for _, keys in chroma.asked(np.zeros(30_000, np.int16)) for k in keys)


def test_integral_image_is_the_plain_sum():
    frames = np.abs(np.random.default_rng(1).normal(size=(40, 12))).astype(np.float32)
    got = chroma.pack(frames)
    shape, c, h, w = chroma._filters()[2]
    assert shape == 2
    for t in range(len(got)):
        a, b = frames[t : t + w // 2, c : c + h].sum(), frames[t + w // 2 : t + w, c : c + h].sum()
        code = int(np.digitize(np.log1p(a) - np.log1p(b), (-chroma.LEVEL, 0, chroma.LEVEL)))
        assert int(got[t]) >> 4 & 3 == (0, 1, 3, 2)[code]


# --- 4: neighbours ---


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[200:320] = x[199]
    vectors = [(k, v.tolist(), 0.5) for k, v in enumerate(x)] + [(9001, None, 1.0), (9002, [0.0] * 16, 1.0), (9003, [float("nan")] * 16, 1.0), (9004, [None] + [1.0] * 15, 1.0), (9005, [float("inf")] + [1.0] * 15, 1.0), (9020, [1.0, 2.0], 1.0)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, score double")
    got = ann.nearest(ann.build_index(table, shard_rows=400), table.filter("vec_id % 20 = 0")).toPandas()
    hits = total = 0
    y = x.astype(np.float64)
    for q in range(0, 1500, 20):
        s = (y * y[q]).sum(axis=1)
        want = [k for k in np.lexsort((np.arange(1500), -s)) if k != q][:20]
        g = got[got.query_id == q].sort_values("rank")
        assert list(g["rank"]) == list(range(1, 21)) and q not in set(g.vec_id) and np.array_equal(s[g.vec_id], g.score)
        assert list(zip(-g.score, g.vec_id, strict=True)) == sorted(zip(-g.score, g.vec_id, strict=True))
        hits += len(set(want) & set(g.vec_id))
        total += 20
    assert hits / total >= 0.95
    copies = got[got.query_id == 200].sort_values("rank")
    assert list(copies.vec_id) == [199, *range(201, 220)]
    assert not {9001, 9002, 9003, 9004, 9005} & set(got.query_id) and not set(got.vec_id) & set(range(9001, 9006)) and not len(got[got.query_id == 9020])
    assert ann.nearest(ann.build_index(table.limit(0)), table.limit(0)).count() == 0


def plain_nearest(vectors, queries, k):
    """{query: [(id, score)]} by comparing all pairs; of an id's several vectors the best counts."""
    out = {}
    for q in {a for a, _ in queries}:
        best = {}
        for a, x in queries:
            for b, y in vectors:
                if a == q != b:
                    best[b] = max(best.get(b, -math.inf), float((np.array(x, float) * np.array(y, float)).sum()))
        out[q] = sorted(best.items(), key=lambda t: (-t[1], t[0]))[:k]
    return out


@pytest.mark.parametrize("kind", ["float", "double"])
def test_repeated_ids_and_double_vectors(spark, kind):
    x = np.random.default_rng(6).normal(size=(120, 6)) * (1e60 if kind == "double" else 1)
    x = x.astype(np.float32 if kind == "float" else np.float64)
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    rows += rows[:50] + [(20, x[7].tolist()), (33, x[8].tolist())]
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    asked = table.filter("vec_id % 20 = 0")
    got = {}
    for r in ann.nearest(ann.build_index(table, shard_rows=50), asked).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert got == plain_nearest(rows, [r for r in rows if r[0] % 20 == 0], 20)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_recall_on_the_embeddings(spark):
    table = common.table(spark, "/root/testdata/sf0.01", "embeddings")
    held = {r.vec_id: r.embedding for r in table.collect()}
    ids = np.array(sorted(held))
    x = np.array([held[k] for k in ids.tolist()], dtype=np.float64)
    got = ann.nearest(ann.build_index(table, shard_rows=500), table.filter("vec_id % 20 = 0")).toPandas()
    hits = total = 0
    for q in ids[ids % 20 == 0].tolist():
        s = x @ np.array(held[q], dtype=np.float64)
        want = [k for k in ids[np.lexsort((ids, -s))].tolist() if k != q][:20]
        hits += len(set(want) & set(got[got.query_id == q].vec_id))
        total += len(want)
    assert hits >= 0.97 * total


def test_few_shards(spark):
    count = lambda n, **more: ann.build_index(spark.range(n).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.col("id") + 1.0).alias("embedding")), **more).count()
    assert (count(40, shard_rows=10), count(40, shard_rows=10, shards_first=2), count(40, shard_rows=10, shards_first=2, shard_values=24)) == (4, 2, 4)


def test_flat_arrays_hold_the_graph():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    graph = ann.Graph(x)
    graph.build(list(range(300)))
    again = ann.Graph.load({**graph.flat(), "dim": 8, "vectors": x.ravel()})
    assert again.links == graph.links and again.levels == graph.levels
    assert all(graph.nearest(q, 60)[:5] == again.nearest(q, 60)[:5] for q in x[:20])


def test_default_beam_finds_nearly_all():
    x = np.random.default_rng(3).normal(size=(2048, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = ann.Graph(x)
    graph.build(list(range(len(x))))
    beam = inspect.signature(ann.nearest).parameters["ef"].default
    hits = sum(len(set(graph.nearest(q, beam)[:20]) & set(np.argsort(-(x @ q))[:20].tolist())) for q in x[::8])
    assert hits >= 0.999 * 20 * len(x[::8])


# --- 5: SimHash ---


def plain_print(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(x, seed=42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs, near):
    parent = {k: k for k, _ in pairs}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, (a, x) in enumerate(pairs):
        for b, y in pairs[:i]:
            if near(x, y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {k: find(k) for k in parent}


def test_components(spark, docs, empty):
    rows = simhash.simhash_components(docs).collect()
    prints = {k: plain_print(t) for k, t in enumerate(TEXTS)}
    want = plain_components(list(prints.items()), lambda x, y: (x ^ y).bit_count() <= 3)
    assert len(rows) == docs.count()
    assert all(r.fp % 2**64 == prints[r.doc_id] and r.component_id == want[r.doc_id] for r in rows if r.doc_id is not None)
    assert simhash.simhash_components(empty).count() == 0
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(want.values())) and kept.filter("doc_id IS NULL").count() == 1


def test_no_link_is_lost(spark):
    r = random.Random(8)
    words = [r.getrandbits(64) for _ in range(60)]
    for base in words[:12]:
        w = base
        for _ in range(12):
            for b in r.sample(range(64), r.randint(1, 4)):
                w ^= 1 << b
            words.append(w)
    words = sorted(set(words))
    signed = [w - 2**64 if w >= 2**63 else w for w in words]
    links = simhash.near_links(spark.createDataFrame([(w,) for w in signed], "fp long"))
    roots = {x.node: x.root for x in common.components(links, "t").collect()}
    want = plain_components([(w, w) for w in signed], lambda x, y: ((x ^ y) % 2**64).bit_count() <= 3)
    assert {w: roots.get(w, w) for w in signed} == want


def test_pivots_never_drop_a_near_pair():
    r = random.Random(9)
    for _ in range(300):
        x = r.getrandbits(64)
        y = x
        for b in r.sample(range(64), 3):
            y ^= 1 << b
        assert max(abs((x ^ p).bit_count() - (y ^ p).bit_count()) for p in simhash.PIVOTS) <= 3


def test_large_bands_are_joined(spark):
    # copies of a text that differ in one word of 120 each: shingles in common 111 of 121 with the text (0.92), 106 of 126 with one another (0.84)
    r = random.Random(14)
    words = [f"{r.choice(WORDS)}{r.randrange(1000)}" for _ in range(120)]
    rows = [(k, " ".join([*words[:at], f"changed{k}", *words[at + 1 :]])) for k, at in enumerate(r.sample(range(5, 115), 60))]
    rows += [(100 + k, " ".join(f"{r.choice(WORDS)}{r.randrange(1000)}" for _ in range(120))) for k in range(20)]
    texts = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.xxhash64("text"))
    sketches = common.save(simhash.through_arrow(texts, simhash.partial(simhash._sketches, shingle=3, words=5), "doc_id long, fp long, part long, n int, bands array<long>"), "t")
    links = simhash.similar_links(texts, sketches, spark.createDataFrame([], "a long, b long"), side=4)
    roots = {x.node: x.root for x in common.components(links, "t").collect()}
    prints = {x.doc_id: x.fp for x in sketches.collect()}
    assert len({roots[prints[k]] for k in range(60)}) == 1 and not {prints[100 + k] for k in range(20)} & set(roots)


def test_similar_links_lose_no_pair(spark):
    # a passage that all texts share, and tails of several lengths: many similar pairs, none of them by fingerprints
    r = random.Random(15)
    common_words = [f"c{k}" for k in range(60)]
    rows = []
    for k in range(60):
        tail = [f"t{k // 6}x{j}" for j in range(30 + k // 6 + r.randrange(6))]
        for j in range(0, len(tail), 9):
            if r.random() < 0.2:
                tail[j] = f"o{k}x{j}"
        rows.append((k, " ".join(common_words + tail)))
    rows += [(100, ""), (101, None), (102, "one"), (103, "one two three four five six"), (104, rows[0][1])]
    texts = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.xxhash64("text"))
    sketches = common.save(simhash.through_arrow(texts, simhash.partial(simhash._sketches, shingle=3, words=5), "doc_id long, fp long, part long, n int, bands array<long>"), "t")
    prints = {x.doc_id: x.fp for x in sketches.collect()}

    def grams(text):
        w = (text or "").split()
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    of = [(prints[k], grams(t)) for k, t in rows]
    want = {(min(x, y), max(x, y)) for i, (x, g) in enumerate(of) for y, h in of[:i] if x != y and g and h and 10 * len(g & h) >= 8 * len(g | h)}
    sets = spark.createDataFrame([(prints[k], simhash.shingles(t).view("int64").tolist()) for k, t in rows], "part long, found array<long>").dropDuplicates(["part"])
    named = sets.select("part", F.col("part").alias("fp"), F.col("part").alias("root"))
    for side in (3, 2000):  # salted or not, all similar pairs are candidates
        got = {(min(x.a, x.b), max(x.a, x.b)) for x in simhash._verified(simhash._candidates(named, sets, 0.8, side), sets, 0.8).collect()}
        assert got == want and len(want) > 50
    linked = simhash.similar_links(texts, sketches, spark.createDataFrame([], "a long, b long"), side=3)
    roots = {x.node: x.root for x in common.components(linked, "t").collect()}
    plain = dict(plain_components([(k, k) for k in sorted(set(prints.values()))], lambda x, y: (min(x, y), max(x, y)) in want))
    assert all((roots.get(x, x) == roots.get(y, y)) == (plain[x] == plain[y]) for x in plain for y in plain)


def test_thinned_links_connect_the_same():
    # batches of random links, repeated and looped ones too, with and without a new beginning at 20 nodes
    r = random.Random(16)
    pairs = [(r.randrange(200), r.randrange(200)) for _ in range(130)]
    pairs += pairs[:50] + [(7, 7)]
    batches = [pa.RecordBatch.from_arrays([pa.array([x for x, _ in part], pa.int64()), pa.array([y for _, y in part], pa.int64())], ["a", "b"]) for part in (pairs[k : k + 40] for k in range(0, len(pairs), 40))]
    plain = dict(plain_components([(k, k) for k in range(200)], lambda x, y: (x, y) in pairs or (y, x) in pairs))
    for most in (20, 500_000):
        kept = [(x["a"], x["b"]) for b in simhash._joining(iter(batches), most) for x in b.to_pylist()]
        assert set(kept) <= set(pairs) and dict(plain_components([(k, k) for k in range(200)], lambda x, y: (x, y) in kept or (y, x) in kept)) == plain  # noqa: B023
    assert len(kept) == 200 - len(set(plain.values()))  # a forest
    assert not list(simhash._joining(iter([])))


def test_near_copies_by_shingles(spark):
    # of 200 words: one changed in four places shares 176 of 216 shingles (0.81), one changed in five 171 of 221 (0.77)
    r = random.Random(12)
    rows, want = [], {}
    for k in range(0, 60, 3):
        words = [f"{r.choice(WORDS)}{r.randrange(1000)}" for _ in range(200)]
        for j, changed in enumerate((0, 4, 5)):
            other = list(words)
            for at in range(changed):
                other[20 + 30 * at + 7 * j] = f"other{j}x{at}"
            rows.append((k + j, " ".join(other)))
        want |= {k: k, k + 1: k, k + 2: k + 2}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x for x in simhash.simhash_components(docs).collect()}
    prints = {k: x.fp for k, x in got.items()}
    far = [k for k in range(0, 60, 3) if min(((prints[a] ^ prints[b]) % 2**64).bit_count() for a in (k, k + 1) for b in (k + 1, k + 2) if a != b) > 3 and ((prints[k] ^ prints[k + 2]) % 2**64).bit_count() > 3]
    assert len(far) > 10 and all(got[k + j].component_id == want[k + j] for k in far for j in range(3))
    assert {x.doc_id for x in simhash.one_of_each(docs).collect()} >= {k for k in far} and not {x.doc_id for x in simhash.one_of_each(docs).collect()} & {k + 1 for k in far}
    assert {x.component_id for x in simhash.simhash_components(docs, similar=None).collect()} >= {k + 1 for k in far}


# --- 6: spans ---


def plain_repeats(docs):
    """{(doc_id, text): positions covered} by comparing all spans with all others."""
    first, out = {}, {}
    for doc, text in sorted(set(docs), key=lambda d: (d[0], xxhash.xxh64_intdigest((d[1] or "").encode(), seed=42))):
        parts = [text[a:b].lower().split() for a, b in spans.sentences(text)]
        for k in range(len(parts) - 1):
            if len(parts[k]) + len(parts[k + 1]) >= 12:
                at = first.setdefault((" ".join(parts[k]), " ".join(parts[k + 1])), (doc, text, k))
                if at != (doc, text, k):
                    out.setdefault((doc, text), set()).update((k, k + 1))
    return out


def test_spans(spark):
    passage = "The first sentence of the passage has words. The second has others, and goes on. A third ends it here."
    rows = [(1, prose(1, 50) + ". " + passage), (2, "Own begin. " + passage + "\n" + prose(2, 50)), (3, prose(5, 80)), (3, prose(6, 80)), (4, passage.upper()), (5, None), (6, ""), (7, "Short. Short. Short. Short."), (8, " ".join([prose(7, 30)] * 3)), (1, prose(1, 50) + ". " + passage), (None, passage)]
    table = spark.createDataFrame([(k, t, "x", 1, 2, "p", [3], "q") for k, t in rows], "doc_id long, text string, removed string, pos int, _text int, part string, positions array<int>, row string")
    got = spans.remove_repeats(table).collect()
    want = plain_repeats([(k, t) for k, t in rows if k is not None and t])
    assert len(got) == len(rows)
    for r in got:
        sources = [t for k, t in rows if k == r.doc_id]
        options = []
        for t in sources:
            gone = want.get((r.doc_id, t), set()) if r.doc_id is not None else set()
            options.append("".join(t[a:b] for n, (a, b) in enumerate(spans.sentences(t)) if n not in gone) if t else t)
        assert r.text in options
        assert bool(r.repeats.n) == bool(r.repeats.removed)
    assert {r.doc_id for r in got if r.repeats.n} >= {2, 4} and {r.doc_id: r.text for r in got}[2].startswith("Own begin.")
    assert spans.remove_repeats(table.limit(0)).count() == 0


def test_sentences_are_the_whole_text():
    for t in TEXTS + ["a.b c! d\n\n e", "x" * 5000, " ".join(f"w{k}" for k in range(500))]:
        parts = spans.sentences(t)
        assert "".join((t or "")[a:b] for a, b in parts) == (t or "")


def numbered(tag, n):
    return " ".join(f"{tag}{k}" for k in range(n))


def test_passages_inside_sentences_go_whole(spark):
    passage = numbered("p", 51)
    rows = [(1, f"{numbered('a', 9)} {passage} {numbered('b', 9)}."), (2, f"{numbered('c', 30)} {passage.upper()} {numbered('d', 30)}."), (3, numbered("e", 50)), (4, numbered("g", 60)), (5, numbered("g", 60))]
    got = {r.doc_id: r for r in spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].repeats.n == got[3].repeats.n == got[4].repeats.n == 0
    assert got[2].text == f"{numbered('c', 30)} {numbered('d', 30)}." and got[5].text == ""
    (cut,) = got[2].repeats.removed
    assert rows[1][1][cut.start : cut.end].split() == passage.upper().split()


def test_passages_of_short_lines_go(spark):
    verse = "\n".join(numbered(f"v{k}x", 5) for k in range(9))
    rows = [(1, f"{numbered('a', 14)}.\n{verse}\n{numbered('b', 14)}."), (2, f"{numbered('c', 14)}.\n{verse}\n{numbered('d', 14)}.")]
    got = {r.doc_id: r for r in spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].text == rows[0][1] and got[2].repeats.n == 9
    assert got[2].text == f"{numbered('c', 14)}.\n{numbered('d', 14)}."


# --- 7: packing ---


def test_tokens_are_the_tokenizers(docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    texts = [*TEXTS, "it's <|endoftext|> don't!! a²b ½ é́ ẞ", "x\x1cy\x85z", "Ünï ÀÉß ÿþ ***", "a" * 3000]
    want = [np.array(plain.encode(t or "", add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    mine = packing.WordTokenizer(path, most=5)
    assert mine.encode(texts) == want and mine.encode(texts[::-1]) == want[::-1]


def test_packing(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = common.save(packing.token_pieces(docs, path, capacity=256, with_ids=True), "t")
    packed = packing.pack_pieces(pieces, 256)
    rows = packed.collect()
    plain = Tokenizer.from_file(path)
    whole = {k: [*plain.encode(t or "", add_special_tokens=False).ids, 0] for k, t in enumerate(TEXTS)}
    for k, ids in whole.items():
        mine = sorted({(r.piece, r.start, r.length, bytes(r.ids), r.ids_crc32) for r in rows if r.doc_id == k})
        assert np.concatenate([np.frombuffer(m[3], "<u4") for m in mine]).tolist() == ids and all(m[4] == zlib.crc32(m[3]) and m[1] == 256 * m[0] for m in mine)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(rows) == pieces.count() and len(by) <= -(-sum(r.length for r in rows) // 256) + 1
    joined = packing.sequences(packed).collect()
    assert all(len(r.ids) == 4 * r.length for r in joined) and sum(r.length for r in joined) == sum(r.length for r in rows)
    assert packing.pack_documents(empty, path).count() == 0


def test_fullest_is_the_best_subset():
    r = random.Random(6)
    for _ in range(60):
        counts, room = Counter(r.randint(1, 20) for _ in range(r.randint(1, 8))), r.randint(0, 40)
        items = list(counts.elements())
        best = max(s for pick in product((0, 1), repeat=len(items)) if (s := sum(a for a, p in zip(items, pick, strict=True) if p)) <= room)
        chosen = packing.fullest(dict(counts), room)
        assert sum(k * n for k, n in chosen.items()) == best and all(n <= counts[k] for k, n in chosen.items())
    plan = packing.slack_plan({5: 3, 4: 2, 1: 1}, 10)
    used = Counter()
    for times, chosen in plan:
        assert sum(k * n for k, n in chosen.items()) <= 10
        used.update({k: n * times for k, n in chosen.items()})
    assert used == {5: 3, 4: 2, 1: 1} and packing.slack_plan({}, 10) == []


# --- 8: HTML ---


def test_main_text():
    page = "<html><head><title>T</title></head><body><header>Site</header><nav><a href=x>Home</a></nav><aside>Side</aside><article><h1>A &amp; B</h1><p>One<b> two</b>\n three<p>Four&nbsp;five<script>var a='</p>'</script><div class='ad'>Buy</div><p>Six</article><div class=comments><p>Nice one, I like this very much indeed, thanks.</p></div><form>Mail <input></form><footer>&copy;</footer></body></html>"
    assert html_text.main_text(page) == "A & B\nOne two three\nFour five\nSix"
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p") == ""
    soup = "<body><ul><li><a href=1>Menu</a><li><a href=2>More menu</a></ul><div><p>" + "Long text of a page without names. " * 4 + "</p><p>Tail.</p></div><div class='cookie-notice'>We use cookies</div><div>(c) x</div>"
    assert html_text.main_text(soup) == ("Long text of a page without names. " * 4).strip() + "\nTail."
    assert len(html_text.main_text("<article>" + "<p>x y</p>" * 20000)) == 4 * 20000 - 1


def test_text_after_an_inline_advert_stays():
    long = "x" * 200
    ad = "<div class='ad'>Buy</div>"
    assert html_text.main_text(f"<div><p>{long}</p>{ad}<p>It ends here.</p></div>") == f"{long}\nIt ends here."
    assert html_text.main_text(f"<body><div>{long}{ad}{ad}Then.{ad}<p>End.</p></div>{ad}<div>(c) x</div>") == f"{long}\nThen.\nEnd."
    assert html_text.main_text(f"<body><div>{long}</div>{ad}<div>(c) x</div>") == long


@pytest.mark.parametrize("page", ["<p>x</p><a " + '"' * 200_000, '<a href="x' * 20_000, '<script "' * 25_000, "<div>" * 60_000 + "</p>" * 60_000, "<" * 200_000, "<!--" * 50_000, "</" * 100_000, "<a b='" * 40_000, "<a " + "= '" * 60_000, "&" * 100_000, "<p class='" + "a " * 90_000])
def test_malformed_pages_take_no_longer(page):
    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 5


def test_quotes_and_raw_elements():
    assert html_text.main_text("<p title='a > b' data-x=\"<p>\">One < two & 3 <4") == "One < two & 3 <4"
    assert html_text.main_text("<p>don\"t <b x=\"y>z\">this</b> <i it's>that</i></p><SCRIPT>a</p></scripty></Script >!") == "don\"t this that\n!"
    assert html_text.main_text("<article><p>a <math><mi>x</mi></math> <svg><text>y</text></svg> <object>z</object> <video>v</video> b<select><option>no</select><noscript>no</noscript></article>") == "a x y z v b"
    assert html_text.main_text("<p>" + "word " * 30 + "<style>" + "p{}" * 100) == ("word " * 30).strip()


def plain_choice(lines, parts):
    """Lines by windows over the whole page with its empty lines written out, a part at a time; no links, no main elements."""
    rows, at = [], {}
    for k, x in enumerate(lines):
        rows += [None] * (2 * x.gap - 1 if k and x.gap else 0)
        at[k] = len(rows)
        rows.append(k)
    weigh = lambda row, part: lines[row].free if row is not None and parts[row] == part else 0
    windows = {part: [sum(weigh(r, part) for r in rows[k : k + html_text.WINDOW]) for k in range(len(rows))] for part in set(parts)}
    most = {part: max(w) for part, w in windows.items()}
    surge = min(html_text.SURGE, max(most.values(), default=0) / 4)
    runs = []  # lines of one part without an empty window between neighbours
    for k in range(len(lines)):
        if k and parts[k] == parts[k - 1] and at[k] - at[k - 1] <= html_text.WINDOW:
            runs[-1].append(k)
        else:
            runs.append([k])
    good = [most[parts[r[0]]] >= surge for r in runs]
    good = [g or 0 < n < len(good) - 1 and good[n - 1] and good[n + 1] for n, g in enumerate(good)]
    return [k for r, g in zip(runs, good, strict=True) if g for k in r]


def test_windows_decide_as_in_the_plain_version():
    r = random.Random(11)
    dropped = 0
    for _ in range(400):
        html, depth = "<div>", 1
        for _ in range(r.randint(1, 25)):
            move = r.random()
            if move < 0.3:
                html, depth = html + "<div>", depth + 1
            elif move < 0.55 and depth > 1:
                html, depth = html + "</div>", depth - 1
            html += f"<p>{'x' * r.choice((5, 20, 60, 200, 500))}</p>"
        lines = html_text.lines_of(html)
        chosen = html_text.chosen_lines(lines)
        assert chosen == plain_choice(lines, html_text.parts_of(lines))
        dropped += len(lines) - len(chosen)
    assert dropped > 100


def test_regions_and_gaps():
    lines = html_text.lines_of("<body>a<div>b<p>c</p><div><p>d</p></div></div><div>e</div><p>f<div hidden>x</div>g")
    assert [(x.text, x.gap, x.meet) for x in lines] == [("a", 0, 1), ("b", 1, 1), ("c", 0, 2), ("d", 1, 2), ("e", 3, 1), ("f", 1, 1), ("g", 0, 1)]
    assert html_text.parts_of(lines) == [-1, 1, 1, 1, 4, -1, -1]


LONG, OTHER = prose(21, 60), prose(22, 50)

#: Pages and the text that a reader marked as the article.
MARKED = [
    (f"<a name='top'><p>{LONG}</p><p>More text here.</p>", f"{LONG}\nMore text here."),
    (f"<p>{LONG}<a href=x>never closed<p>{OTHER}", f"{LONG}never closed\n{OTHER}"),
    (f"<body><form action=x><div>Site</div><div><p>{LONG}</p><input><p>End.</p></div><button>Go</button></form></body>", f"{LONG}\nEnd."),
    (f"<div><p>{LONG}</p></div><form>Your mail <input> <label>I agree to everything that is written there</label></form>", LONG),
    (f"<article><p class='social-history'>Of towns.</p><section id='related-work'><p>Related work.</p></section><h2 class='alert'>Alert!</h2><blockquote class='comment'>Quoted.</blockquote><p>{LONG}</p></article>", f"Of towns.\nRelated work.\nAlert!\nQuoted.\n{LONG}"),
    (f"<article><p>{LONG}</p><div class='ad'>Buy this</div><p>{OTHER}</p><p><a href=x>See the whole report</a></p><ul class='comments'><li>{OTHER}</li></ul></article>", f"{LONG}\n{OTHER}\nSee the whole report"),
    (f"<div><p>{LONG}<span aria-hidden='true'>#</span> goes on</p><p><a href=x>All of it is a link</a></p></div>", f"{LONG} goes on\nAll of it is a link"),
    (f"<main><p>{LONG}</p></main><div>{OTHER}</div>", LONG),
    (f"<article><p>Teaser.</p></article><div><p>{LONG}</p><p>{OTHER}</p></div>", f"{LONG}\n{OTHER}"),
    (f"<article><p>{LONG}</p><p>{OTHER}</p></article><article><p>Next: short.</p></article>", f"{LONG}\n{OTHER}"),
    (f"<div>Home</div><div>About us</div><div><p>{LONG}</p><p>Short.</p><p>{OTHER}</p></div><div>Copyright 2020</div>", f"{LONG}\nShort.\n{OTHER}"),
    (f"<div id=w><div>My site</div><div><a href=1>One</a> <a href=2>Two</a></div><div><div>{LONG}</div><div>Short.</div><div>{OTHER}</div></div><div>(c) me</div></div>", f"{LONG}\nShort.\n{OTHER}"),
    (f"<table><tr><td><ul><li><a href=1>a</a><li><a href=2>b</a><li><a href=3>c</a><li><a href=4>d</a></ul><td><h1>Head</h1><p>{LONG}</p></table>", f"Head\n{LONG}"),
    (f"<div><h1>Head</h1><h2 class='menu-of-the-day'>Soup</h2><p>{LONG}</p></div><div>12 readers</div><div>Tags: x, y</div>", f"Head\nSoup\n{LONG}"),
    (f"<div><div><p>{LONG}</p></div><div><div><p>Deeper.</p></div></div></div><div><p>Imprint</p></div>", f"{LONG}\nDeeper."),
    ("<div><a href=1>Only</a></div><div><a href=2>links</a></div>", ""),
]


def test_hand_marked_pages():
    kept = wanted = right = 0
    for page, article in MARKED:
        got, want = Counter(html_text.main_text(page).split("\n")), Counter(article.split("\n"))
        kept, wanted, right = kept + sum(got.values()), wanted + sum(want.values()), right + sum((got & want).values())
    assert right == kept == wanted  # precision and recall of lines


def test_windows_change_the_result_without_useful_tags():
    pages = [page for page, _ in MARKED if "<article" not in page and "<main" not in page]
    changed = sum(html_text.main_text(page) != "\n".join(x.text for x in html_text.lines_of(page)) for page in pages)
    assert changed >= 7


def test_a_teaser_in_a_main_element_loses():
    body = "<div>" + "".join(f"<p>{prose(k, 40)}</p>" for k in range(4)) + "</div>"
    teaser = "<div class='content'><p>Teaser.</p></div>"
    assert html_text.main_text(teaser + body).split("\n") == [prose(k, 40) for k in range(4)]
    assert html_text.main_text(teaser + "<div>(c) somebody</div>") == "Teaser."


def test_extract_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<main>a<br>b</main>", 5), (1, "u", "<main>a<br>b</main>", 5), (2, None, None, None)], "page_id long, url string, html string, n_chars int")
    assert sorted((r.page_id, r.text, r.n_chars) for r in html_text.extract_text(pages).collect()) == [(1, "a b", 3), (1, "a b", 3), (2, "", 0)]
    assert html_text.extract_text(pages.limit(0)).count() == 0


# --- 9: lattice ---


def segmentations(model, word):
    """(pieces' numbers) of every way to cut a word."""
    s = "▁" + word

    def cuts(at):
        if at == len(s):
            yield ()
            return
        if s[at] not in model.pieces or at and s[at] == "▁":
            ends = {at + 1: tuple(model.bytes[list(s[at].encode())].tolist())}
        else:
            ends = {}
        for k in range(at + 1, min(len(s), at + model.longest) + 1):
            if s[at:k] in model.pieces and not (at and s[at] == "▁"):
                ends[k] = (model.pieces[s[at:k]],)
        for k, ids in ends.items():
            for rest in cuts(k):
                yield ids + rest

    return list(cuts(0))


def plain_lattice(model, words):
    """(log probabilities, expected pieces) over all segmentations."""
    logs, counts = [], Counter()
    for w, n in words.items():
        ways = [(ids, math.exp(sum(model.scores[k] for k in ids))) for ids in segmentations(model, w)]
        whole = sum(p for _, p in ways)
        logs.append(math.log(whole) + model.stop)
        for ids, p in ways:
            for k in ids:
                counts[k] += n * p / whole
    return logs, counts


def test_likelihood_is_the_sum_over_segmentations():
    path = public_tokenizers.path("piece_bpe_32k.model")
    words = {"the": 3, "ation": 1, "thonéx": 2, "a日b": 1, "x": 5, "a▁b": 1, "▁": 1, "ab": 2}
    plain = lattice.Lattice(path)
    for model in (plain, lattice.Lattice(path, plain.expected(list(words), np.array(list(words.values()), float)), 16.0)):
        logs, counts = plain_lattice(model, words)
        assert np.allclose(model.likelihoods(list(words)), logs, rtol=1e-9)
        got = model.expected(list(words), np.array(list(words.values()), float))
        assert np.allclose([got[k] for k in counts], list(counts.values())) and math.isclose(got.sum(), sum(counts.values()))
        later = [k for p, k in model.pieces.items() if p[0] != "▁"] + model.bytes.tolist()
        assert math.isclose(sum(math.exp(model.scores[k]) for k in later) + math.exp(model.stop), 1) and math.isclose(sum(math.exp(model.scores[k]) for p, k in model.pieces.items() if p[0] == "▁"), 1)
    assert np.isfinite(plain.likelihoods(["z" * 5000, ""])).all() and not len(plain.likelihoods([]))


@pytest.mark.parametrize("most", [250_000, 3])
def test_scores(spark, docs, empty, most):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = lattice.score_documents(docs, path, most_frequent=most).collect()
    counted = [(k, t) for k, t in enumerate(TEXTS)] + [(0, TEXTS[0]), (None, "no id here")]
    learned = [(t or "").encode().lower().split() for k, t in counted if k is None or zlib.crc32(str(k).encode()) % 7 != 2]
    counts = Counter(w for ws in learned for w in ws)
    tokens, types = sum(counts.values()) + len(learned), len(counts) + 1
    assert len(rows) == docs.count()
    seen = {w.decode(): n for w, n in counts.items()}
    model = lattice.Lattice(path)
    for _ in range(4):
        weights = np.zeros(model.size + 1)
        for k, n in plain_lattice(model, seen)[1].items():
            weights[k] = n
        model = lattice.Lattice(path, weights, float(sum(seen.values())))
    every = {w.decode(): 1 for k, t in counted for w in (t or "").encode().lower().split()}
    spelled = {w.encode(): x for w, x in zip(every, plain_lattice(model, every)[0], strict=True)}
    end = (len(learned) + 1) / (tokens + 2)
    for r in rows:
        words = ("no id here" if r.doc_id is None else TEXTS[r.doc_id] or "").encode().lower().split()
        base = sum(math.log10((counts[w] + 1) / (tokens + types + 1)) for w in words) + math.log10((len(learned) + 1) / (tokens + types + 1))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words) + 1, 1 + sum(w in counts for w in words), tokens)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        score = sum(spelled[w] + math.log(1 - end) for w in words) + math.log(end)
        assert math.isclose(r.score, score / math.log(10), rel_tol=1e-9)
    assert lattice.score_documents(empty, path).count() == 0


def test_words_in_blocks_score_as_together(monkeypatch):
    lat = lattice.Lattice(public_tokenizers.path("piece_bpe_32k.model"))
    r = random.Random(1)
    words = ["".join(r.choice("thaneroionésß日▁x😀") for _ in range(n)) for n in (1, 2, 5, 9, 17, 40, 41, 100, 300, 3000)] + ["a", "", "the", "the"]
    times = np.arange(1.0, len(words) + 1)
    monkeypatch.setattr(lattice, "_FEW", 0)
    together, pieces = lat.likelihoods(words), lat.expected(words, times)
    monkeypatch.setattr(lattice, "_FEW", 10**9)
    for block, scaled in ((4096, 8), (20, 3), (7, 1)):
        monkeypatch.setattr(lattice, "_BLOCK", block)
        monkeypatch.setattr(lattice, "_SCALED", scaled)
        assert np.allclose(lat.likelihoods(words), together, rtol=1e-12, atol=1e-9)
        assert np.allclose(lat.expected(words, times), pieces, rtol=1e-9, atol=1e-6)


def test_a_very_long_word_takes_bounded_memory():
    import tracemalloc

    lat = lattice.Lattice(public_tokenizers.path("piece_bpe_32k.model"))
    word = "".join(random.Random(2).choice("abcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(500_000))
    tracemalloc.start()
    lat.expected([word], np.ones(1))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60 << 20


# --- 10: sharding ---


def test_differencing_balances():
    r = random.Random(4)
    items = [(k, r.randint(1, 1000)) for k in range(400)]
    place = sharding.differencing(items, 8)
    sums = Counter()
    for k, s in items:
        sums[place[k]] += s
    assert set(place) == {k for k, _ in items} and max(sums.values()) - min(sums.values()) <= 2
    assert sharding.differencing([], 4) == {} and sharding.differencing([("a", 5)], 3) in ({"a": 0},)
    assert sorted(Counter(sharding.differencing([(k, 7) for k in range(6)], 3).values()).values()) == [2, 2, 2]
    two = sharding.differencing([("a", 8), ("b", 7), ("c", 6), ("d", 5), ("e", 4)], 2)
    assert abs(sum(s if two[k] else -s for k, s in (("a", 8), ("b", 7), ("c", 6), ("d", 5), ("e", 4)))) == 2


def plain_differencing(sizes, ways):
    """Sums of the parts, by looking for the two partial partitions of the largest spread each time."""
    partial = [[x] + [0] * (ways - 1) for x in sorted(sizes, reverse=True)]
    while len(partial) > 1:
        partial.sort(key=lambda p: p[0] - p[-1], reverse=True)
        first, second, *rest = partial
        partial = [*rest, sorted((a + b for a, b in zip(first, reversed(second), strict=True)), reverse=True)]
    return partial[0]


@pytest.mark.parametrize("ways", [2, 3, 7])
def test_differencing_is_the_plain_one(ways):
    for seed in range(30):
        r = random.Random(seed)
        sizes = r.sample(range(1, 10**9), r.randint(1, 40))  # no ties, whose order is free
        place = sharding.differencing(list(enumerate(sizes)), ways)
        sums = Counter({part: 0 for part in range(ways)})
        for key, part in place.items():
            sums[part] += sizes[key]
        assert sorted(sums.values(), reverse=True) == plain_differencing(sizes, ways)


def test_shards_differ_by_little_and_keep_groups(spark):
    """One text holds a third of all bytes, and so gets a shard to itself; the others are within one small text of each other."""
    r = random.Random(8)
    texts = ["x" * r.randint(1, 400) + str(k) for k in range(3000)] + ["the same words again and again"] * 9000
    rows = sharding.shard_by_bytes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), shards=6).collect()
    sums, hot = Counter(), set()
    for x in rows:
        sums[x.shard] += x.size
        if x.doc_id >= 3000:
            hot.add(x.shard)
    assert len(hot) == 1 and len(sums) == 6
    rest = [n for shard, n in sums.items() if shard not in hot]
    assert max(rest) - min(rest) <= 420


@pytest.mark.parametrize("bundles", [8192, 2])
def test_shards(docs, empty, bundles):
    rows = sharding.shard_by_bytes(docs, shards=4, bundles=bundles).collect()
    assert len(rows) == docs.count()
    by_text, slots = {}, {}
    for r in rows:
        text = "no id here" if r.doc_id is None else TEXTS[r.doc_id] or ""
        assert (r.size, r.text_crc32) == (len(text.encode()) + 8, zlib.crc32(text.encode()))
        by_text.setdefault(text, set()).add(r.shard)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(len(s) == 1 for s in by_text.values()) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.shard_by_bytes(empty).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(1, k) for k in range(2, 40)] + [(7, 7)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {k: 100 for k in range(100, 141)} | {k: 1 for k in range(1, 40)}
    assert common.components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def test_shared_folder_is_the_clusters(spark):
    assert common.shared_dir(spark) == common.shared_dir(spark) and F is not None
