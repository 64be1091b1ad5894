"""Queries of this subpackage: each applies an operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, centroids, chroma, html_text, lattice, lexical, mixing, packing, secrets, sharding, simhash, spans, toxicity
from .common import save, table

TOKENIZER = "word_bpe_49k.json"
VOCABULARY = "piece_bpe_32k.model"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored for toxicity by a field learned from the labels outside the held-out fold; null and empty texts are scored as documents without tokens. Repeated rows give repeated rows, an empty table none."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its raked weight, its probability and whether the draw keeps it; texts without tokens weigh nothing. Repeated rows give repeated rows, an empty table none."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"), "kept")


def op3_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings rendered of vectors: classes of copies, and where noisy excerpts, cut off the frames, of those with ids divisible by 50 stand."""
    vectors = table(spark, sf_dir, "embeddings")
    prints = save(chroma.fingerprints(vectors, "vec_id", "embedding", chroma.tones), "chroma-prints")
    return chroma.align(prints, chroma.questions(vectors, "vec_id", "embedding", chroma.excerpt))


def op4_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20; vectors null, zero or with null or non-finite components take no part. An empty table gives no rows."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(ann.build_index(vectors), vectors.filter(F.pmod("vec_id", F.lit(20)) == 0))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the smallest doc_id of its component; null and wordless texts share fingerprint zero. Repeated rows give repeated rows, an empty table none."""
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), similar=None)
    return found.select("doc_id", simhash.hex_of("fp").alias("fingerprint"), "component_id")


def op6_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without repeated spans, the spans and their number; the first place of a span, by doc_id, stays. Null texts stay null. Repeated rows give repeated rows, an empty table none."""
    cleaned = spans.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "text", F.col("repeats.removed").alias("removed"), F.col("repeats.n").alias("n_removed"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 2048 tokens; a null text is its end token. An empty table gives no rows."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text; null and empty pages give an empty one. Repeated rows give repeated rows, an empty table none."""
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op9_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability under the subword lattice and under word counts with one added; a null text is its end alone. Repeated rows give repeated rows, an empty table none."""
    return lattice.score_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 24 shards of nearly equal bytes; a null text has the bytes of its length alone. An empty table gives no rows."""
    dealt = sharding.shard_by_bytes(table(spark, sf_dir, "documents"))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document, by the three patterns and by the battery; null and empty texts have none. Repeated rows give repeated rows, an empty table none."""
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kept vector with its cluster after ten rounds and the exact squared distance; vectors of another length or with null or non-finite components are left out. Repeated rows give repeated rows, an empty table none."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item, with exact scores; items without known terms have none. An empty table gives no rows."""
    return lexical.search(lexical.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_mixing": op2_mixing,
    "op6_spans": op6_spans,
    "op7_packing": op7_packing,
    "op3_chroma": op3_chroma,
    "op4_hnsw": op4_hnsw,
    "op5_simhash": op5_simhash,
    "op8_html_text": op8_html_text,
    "op9_lattice": op9_lattice,
    "op10_sharding": op10_sharding,
    "op11_secrets": op11_secrets,
    "op12_centroids": op12_centroids,
    "op13_lexical": op13_lexical,
}

ORACLES: dict[str, str] = {"op2_mixing": mixing.oracle(), "op12_centroids": centroids.oracle(), "op13_lexical": lexical.oracle()}
