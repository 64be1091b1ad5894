"""SimHash near-duplicates: fingerprints, pivot distance tables, shingle similarity, and components of what is linked."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, save, through_arrow

BITS = 64
#: Reference fingerprints: 16 fixed words, mixed from odd multiples of two 64-bit constants.
PIVOTS = tuple((0x9E3779B97F4A7C15 * (2 * k + 1) ^ (0xD1B54A32D192ED03 * (k + 7) >> 3)) & (2**64 - 1) for k in range(16))

#: A text's least hashes under 128 functions, four to a band: two texts of similarity 0.8 agree on one of the 32 bands but for 1 pair in 20 million.
BANDS, DEPTH = 32, 4
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.default_rng(42).integers(0, 2**64, size=(2, BANDS * DEPTH), dtype=np.uint64)


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The SimHash of a UTF-8 text: A-Z lower-cased, words split at ASCII white space, ``shingle`` words a shingle (fewer words: the whole sequence), XXH64 with seed 42; a bit is set if it is in over half of the hashes. No words or null: 0."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    runs = zip(*(words[k:] for k in range(shingle))) if len(words) >= shingle else [words]  # noqa: B905
    hashes = np.array(list(map(partial(xxhash.xxh64_intdigest, seed=42), map(b" ".join, runs))), dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        prints = np.array([fingerprint(x, shingle) for x in b.column(1).cast(pa.binary()).to_pylist()], dtype="<u8")
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp) for each row; fp is the unsigned fingerprint held in a signed long."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return through_arrow(rows, partial(_fingerprints, shingle=shingle), "doc_id long, fp long")


def pivot_table(prints: DataFrame) -> DataFrame:
    """Add the distances of fp to all PIVOTS, eight to a long (d0, d1), a byte each."""
    def packed(pivots):
        out = F.lit(0).cast("long")
        for k, p in enumerate(pivots):
            signed = p - 2**64 if p >= 2**63 else p
            out = out.bitwiseOR(F.shiftleft(F.bit_count(F.col("fp").bitwiseXOR(F.lit(signed))).cast("long"), 8 * k))
        return out

    return prints.withColumn("d0", packed(PIVOTS[:8])).withColumn("d1", packed(PIVOTS[8:]))


def _block_masks(most: int) -> list[int]:
    """Masks over 2 * most of 2 * most blocks: words that differ in at most ``most`` bits agree on one of them."""
    edges = np.linspace(0, BITS, 2 * most + 1).astype(int)
    blocks = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(blocks, most)]


def _forest(prints: np.ndarray, coords: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links (position, position) that join what is within ``most`` bits.

    prints: distinct words, coords: their distances to the pivots. A pair whose coordinates differ by more than
    ``most`` anywhere can't be that near (triangle inequality). So a word is only compared with the words that the
    table leaves: a stretch of those sorted by the first pivot, then less by each further one; the survivors are
    verified. A word that is linked isn't compared as a candidate again, so a dense group costs a few passes, and at
    most len - 1 links come out.
    """
    order = np.argsort(coords[:, 0], kind="stable")
    words, table = prints[order], coords[order].astype(np.int16)
    alone = np.arange(len(order))
    out: list[tuple[int, int]] = []
    while len(alone) > 1:
        ahead, alone = [int(alone[0])], alone[1:]
        while ahead and len(alone):
            x = ahead.pop()
            first = table[alone, 0]
            lo, hi = np.searchsorted(first, table[x, 0] - most), np.searchsorted(first, table[x, 0] + most, side="right")
            near = alone[lo:hi]
            for k in range(1, table.shape[1]):
                if not len(near):
                    break
                near = near[np.abs(table[near, k] - table[x, k]) <= most]
            near = near[np.bitwise_count(words[near] ^ words[x]) <= most]
            if len(near):
                out += [(int(order[y]), int(order[x])) for y in near]
                ahead += near.tolist()
                alone = np.setdiff1d(alone, near, assume_unique=True)
    return out


def _links(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """From rows (table, key, block, fp, d0, d1) sorted by the first three: the links within each run of equal ones."""
    def pack(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    def done(cols: list[np.ndarray]) -> list[tuple[int, int]]:
        *keys, fp, d0, d1 = cols
        found: list[tuple[int, int]] = []
        starts = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)])
        ends = np.r_[starts[1:], len(fp)]
        for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
            run = fp[s:e].view(np.uint64)
            coords = np.stack([d0[s:e], d1[s:e]], axis=1).astype("<i8").view(np.uint8).reshape(e - s, 16)
            found += [(int(fp[s + x]), int(fp[s + y])) for x, y in _forest(run, coords, most)]
        return found

    held: list[list[np.ndarray]] = []  # of the last run, which may go on in the next batch
    for b in batches:
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(6)]
        if not b.num_rows:
            continue
        others = np.flatnonzero(np.any([c != c[-1] for c in cols[:3]], axis=0))
        if not len(others) and (not held or all(h[0] == c[0] for h, c in zip(held[-1][:3], cols, strict=False))):
            held.append(cols)
            continue
        cut = int(others[-1]) + 1 if len(others) else 0
        found = done([np.concatenate(x) for x in zip(*held, [c[:cut] for c in cols], strict=True)])
        held = [[c[cut:] for c in cols]]
        if found:
            yield pack(found)
    if held and (found := done([np.concatenate(x) for x in zip(*held, strict=True)])):
        yield pack(found)


def near_links(prints: DataFrame, most: int = 3, tasks: int | None = None, side: int = 20_000) -> DataFrame:
    """Links (a, b) of distinct fingerprints that connect all that are within ``most`` bits, directly or through others.

    prints: distinct fp. Each is filed under the C(2 most, most) half-words on which a near word must agree with it
    (2 most blocks, of which ``most`` stay whole); words under one half-word are compared through their pivot
    distances and the survivors are verified. Links within a half-word are a forest, never all pairs. A half-word
    holds distinct words only, so a large group of copies is one row. One of over ``side`` words is dealt into parts of
    about that size, and each two parts, or a part by itself, are a block of their own: no task gets more than two
    parts, and no pair is left out.
    """
    signed = [m - 2**64 if m >= 2**63 else m for m in _block_masks(most)]
    keys = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("table", "key")
    large = save(prints.select(keys).groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > side), "simhash-large")
    filed = pivot_table(prints).select(keys, "fp", "d0", "d1")
    if large.isEmpty():
        blocked = filed.withColumn("block", F.lit(0).cast("long"))
    else:
        sized = filed.join(large, ["table", "key"], "left").withColumn("parts", F.coalesce(F.ceil(F.col("n") / side), F.lit(1)))
        sized = sized.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        blocked = sized.withColumn("block", F.least("part", "other") * F.col("parts") + F.greatest("part", "other"))
    blocked = blocked.select("table", "key", "block", "fp", "d0", "d1")
    dealt = blocked.repartition(*([tasks] if tasks else []), "table", "key", "block").sortWithinPartitions("table", "key", "block")
    return through_arrow(dealt, partial(_links, most=most), "a long, b long").distinct()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """The distinct 64-bit hashes of a text's runs of ``words`` words (fewer words: the whole sequence). White space and case make no difference."""
    split = (text or "").lower().split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, split), dtype=np.uint64, count=len(split))
    width = min(words, len(split))
    out = np.zeros(len(split) - width + 1 if split else 0, dtype=np.uint64)
    for k in range(width):
        out = out * _FACTOR + hashes[k : k + len(out)]
    return np.unique(_mixed(out))


def bands(found: np.ndarray) -> np.ndarray:
    """BANDS hashes, each of DEPTH of the least hashes of the shingles found; none for a wordless text."""
    if not len(found):
        return np.zeros(0, dtype=np.int64)
    odd, more = _RANDOM[0] | np.uint64(1), _RANDOM[1]
    least = np.full(BANDS * DEPTH, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(found), 1024):
        np.minimum(least, (odd[:, None] * found[None, at : at + 1024] + more[:, None]).min(axis=1), out=least)
    keys = np.arange(BANDS, dtype=np.uint64)
    for k in range(DEPTH):
        keys = _mixed(keys * _FACTOR + least[k::DEPTH])
    return keys.view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch], shingle: int, words: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column(1).to_pylist()
        prints = np.array([fingerprint(x and x.encode(), shingle) for x in texts], dtype="<u8")
        found = [shingles(x, words) for x in texts]
        more = [pa.array([len(x) for x in found], pa.int32()), pa.array([bands(x) for x in found], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints.view(np.int64)), b.column(2), *more], ["doc_id", "fp", "part", "n", "bands"])


def _shingled(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [shingles(x, words).view(np.int64) for x in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int64()))], ["part", "found"])


def _joining(batches: Iterator[pa.RecordBatch], most: int = 500_000) -> Iterator[pa.RecordBatch]:
    """Of a task's links (a, b) those that join two trees, so that all are still connected; past ``most`` nodes it begins anew."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := above.setdefault(x, x)) != x:
            above[x] = above[up]
            x = up
        return x

    for batch in batches:
        if len(above) > most:
            above.clear()
        kept = []
        for at, (a, b) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            x, y = top(a), top(b)
            if x != y:
                above[max(x, y)] = min(x, y)
                kept.append(at)
        yield batch.take(pa.array(kept, pa.int64()))


def _verified(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """Of pairs (p, q, ...) of texts p, q: the other columns of those whose shingle sets are so similar."""
    both = pairs.join(sets.select(F.col("part").alias("p"), F.col("found").alias("x")), "p").join(sets.select(F.col("part").alias("q"), F.col("found").alias("y")), "q")
    common = F.size(F.array_intersect("x", "y"))
    return both.filter(common >= similar * (F.size("x") + F.size("y") - common) - 1e-9).select(*(c for c in pairs.columns if c not in ("p", "q")))


def _thinned(links: DataFrame) -> DataFrame:
    """Links (a, b) that connect what the given ones do: each task keeps a forest of its own, before anything is shuffled."""
    return through_arrow(links.select("a", "b"), _joining, "a long, b long")


def _prefixes(sets: DataFrame, similar: float) -> DataFrame:
    """(part, shingle, ahead) for the rarest shingles of each set (part, found): sets that are so similar share one of theirs.

    A set's shingles are ranked by the number of sets that have them, ties by value; its prefix is as long as a similar
    set can't miss. Shingles of one set alone stand first and can't be shared, so they are left out. ahead: the
    shingles behind this one in its set.
    """
    each = sets.select("part", F.explode("found").alias("shingle"))
    often = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    ranked = each.join(often, "shingle").groupBy("part").agg(F.array_sort(F.collect_list(F.struct("sets", "shingle"))).alias("shared"))
    n = F.size("found")
    length = n - F.ceil(similar * n - 1e-9) + 1 - (n - F.size("shared"))
    cut = ranked.join(sets, "part").filter(length > 0).select("part", F.size("shared").alias("of"), F.slice("shared", 1, F.greatest(length.cast("int"), F.lit(0))).alias("rare"))
    return cut.select("part", "of", F.posexplode("rare").alias("at", "x")).select("part", F.col("x.shingle").alias("shingle"), (F.col("of") - F.col("at") - 1).alias("ahead"))


def _candidates(named: DataFrame, sets: DataFrame, similar: float, side: int) -> DataFrame:
    """Pairs (p, q, a, b) of the texts (part, fp, root) that differ in root and may be so similar: all that are, and few others.

    They share a shingle of both prefixes, and the shingles from the first shared one on suffice (the pairs that fail
    that at each shared shingle aren't so similar). A shingle in over ``side`` prefixes is salted: its left rows are
    dealt over parts of that size, its right rows go to each, so no task gets a whole group.
    """
    sized = named.join(sets.select("part", F.size("found").alias("n")), "part")
    filed = save(_prefixes(sets, similar).join(sized, "part"), "similar-prefixes")
    ends = filed.groupBy("shingle").agg(F.count(F.lit(1)).alias("rows"), F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y")
    groups = save(ends.select("shingle", F.ceil(F.col("rows") / side).alias("parts")), "similar-groups")
    filed = filed.join(groups, "shingle")
    left, right = (filed.select("shingle", "parts", *(F.col(c).alias(f"{c}{k}") for c in ("part", "fp", "n", "root", "ahead"))) for k in (1, 2))
    left = left.withColumn("salt", F.pmod(F.xxhash64("part1"), F.col("parts"))).drop("parts")
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    size = F.col("n1") + F.col("n2")
    enough = (1 + F.least("ahead1", "ahead2")) * (1 + similar) >= similar * size - 1e-6
    near = F.least("n1", "n2") >= similar * F.greatest("n1", "n2") - 1e-9
    pairs = left.join(right, ["shingle", "salt"]).filter((F.col("part1") < F.col("part2")) & (F.col("root1") != F.col("root2")) & near & enough)
    return pairs.select(F.col("part1").alias("p"), F.col("part2").alias("q"), F.col("fp1").alias("a"), F.col("fp2").alias("b")).distinct()


def similar_links(texts: DataFrame, sketches: DataFrame, links: DataFrame, similar: float = 0.8, words: int = 5, side: int = 2_000) -> DataFrame:
    """Links (a, b) of fingerprints that connect what ``links`` connect, and texts whose ``words``-word shingle sets have a Jaccard similarity of ``similar`` or more, directly or through others.

    texts: (part, text), where part names a text; sketches: (part, fp, n, bands); links: saved links (a, b) of
    fingerprints. Each text is compared with one text of each of its bands, which joins most groups. The texts that
    then share a band with a text of another group are compared by prefixes of their rarest shingles, whatever the
    size of the band, and verified by their sets: every similar pair among them is joined. A group that is joined
    already is never expanded to pairs, and comes out as a link of each fingerprint to its root.
    """
    near = F.least("n", "least.n") >= similar * F.greatest("n", "least.n") - 1e-9
    filed = save(sketches.groupBy("part").agg(F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("bands").alias("bands")), "similar-texts").select("part", "fp", "n", F.explode("bands").alias("band"))
    ends = filed.groupBy("band").agg(F.min(F.struct("part", "fp", "n")).alias("least"), F.max("part").alias("last")).filter("least.part <> last").drop("last")
    filed = save(filed.join(save(ends, "similar-shared"), "band"), "similar-bands")
    asked = filed.select(F.col("part").alias("_asked")).distinct()
    wanted = texts.join(asked, texts["part"] == asked["_asked"], "left_semi").select("part", "text")
    sets = save(through_arrow(wanted, partial(_shingled, words=words), "part long, found array<long>").groupBy("part").agg(F.first("found").alias("found")), "similar-sets")
    pairs = filed.filter((F.col("fp") != F.col("least.fp")) & near).select(F.col("least.part").alias("p"), F.col("part").alias("q"), F.col("least.fp").alias("a"), F.col("fp").alias("b")).distinct()
    links = save(links.select("a", "b").union(_thinned(_verified(pairs, sets, similar))), "similar-links")
    roots = components(links, "similar")
    named = save(filed.join(roots, filed["fp"] == roots["node"], "left").select("part", "fp", "band", F.coalesce("root", "fp").alias("root")), "similar-named")
    split = named.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("band")
    apart = save(named.join(split, "band", "left_semi").select("part", F.col("root").alias("fp"), "root").distinct(), "similar-apart")
    few = save(sets.join(apart.select("part"), "part", "left_semi"), "similar-apart-sets")
    joined = roots.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    return joined.union(_thinned(_verified(_candidates(apart, few, similar, side), few, similar)))


def _rooted(docs: DataFrame, id_col: str, text_col: str, shingle: int, most: int, similar: float | None, words: int) -> DataFrame:
    """(doc_id, fp, root, component_id) for each row of docs, and part (the text's hash) where ``similar`` is given; rows of one component have one root."""
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    if similar is None:
        prints = save(fingerprints(texts, shingle=shingle), "simhash-prints")
    else:
        texts = texts.withColumn("part", F.xxhash64("text"))
        prints = save(through_arrow(texts, partial(_sketches, shingle=shingle, words=words), "doc_id long, fp long, part long, n int, bands array<long>"), "simhash-prints")
    classes = save(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    links = near_links(classes.select("fp"), most)
    if similar is not None:
        links = similar_links(texts, prints, save(links, "simhash-links"), similar, words)
    roots = components(links, "simhash")
    linked = classes.join(roots, classes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = save(linked.join(names, "root").select("fp", "root", "component_id"), "simhash-linked")
    return prints.join(linked, "fp").select("doc_id", "fp", *(["part"] if similar is not None else []), "root", "component_id")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, most: int = 3, similar: float | None = 0.8, words: int = 5) -> DataFrame:
    """(doc_id, fp, component_id) for each row of docs.

    component_id is the smallest doc_id reachable over fingerprints that differ in at most ``most`` bits, the row's
    own included, and over texts whose ``words``-word shingle sets have a Jaccard similarity of ``similar`` or more;
    ``similar`` None: over fingerprints alone. Null and wordless texts have fingerprint 0 and are linked like any
    other. A null doc_id counts for no component's name; a component of null ids only has null. Repeated rows give
    repeated rows; other columns are left aside, whatever their names. An empty table gives no rows.
    """
    return _rooted(docs, id_col, text_col, shingle, most, similar, words).select("doc_id", "fp", "component_id")


def hex_of(col: str) -> Column:
    """A long as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(F.col(col))), 16, "0")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without near-duplicates, by fingerprint or by similarity of 0.8 or more of 5-word shingles, all columns kept.

    Of each component one row stays: that with the smallest doc_id, of several texts under that id the one with the
    least hash, and of rows that repeat id and text one of them. So two texts that aren't near copies both stay, even
    under one id. Null and wordless texts are copies of one another. Rows whose doc_id is null can't be told apart and
    stay. An empty table gives no rows.
    """
    found = _rooted(docs, id_col, text_col, 3, 3, 0.8, 5).filter("doc_id IS NOT NULL")
    counted = found.groupBy("root", "doc_id", "part").agg(F.count(F.lit(1)).alias("n"))
    keep = save(counted.groupBy("root").agg(F.min(F.struct("doc_id", "part", "n")).alias("k")).select(F.col("k.doc_id").alias("doc_id"), F.col("k.part").alias("part"), F.col("k.n").alias("n")), "simhash-keep")
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), docs[f"`{id_col}`"].cast("long").alias("doc_id"), F.xxhash64(docs[f"`{text_col}`"].cast("string")).alias("part"))
    parts = [rows.join(keep.filter("n = 1"), ["doc_id", "part"], "left_semi"), rows.filter("doc_id IS NULL")]
    often = keep.filter("n > 1").select("doc_id", "part")
    if not often.isEmpty():
        parts.append(rows.join(often, ["doc_id", "part"]).dropDuplicates(["doc_id", "part"]))
    kept = reduce(DataFrame.union, [x.select("row") for x in parts])
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
