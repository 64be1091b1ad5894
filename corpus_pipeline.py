"""From raw documents to packed training sequences: five stages, each over all that the one before kept.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; it is written as Parquet and read again as the next
one's docs. All but the last give the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prediolake.llm import mixing, packing, simhash, spans, toxicity
from prediolake.llm.common import save, table
from prediolake.llm.queries import TOKENIZER

#: A stage's decisions come from models and counts over the documents: SQL can't express them.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the conditional random field scores below 0.5; it is fitted to the labels outside the held-out fold.

    Null, empty and wordless texts score low and stay; repeated rows score alike; no rows: none.
    """
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component over near SimHashes and over 5-word shingle sets of similarity 0.8 or more: that with the smallest doc_id.

    Null and wordless texts are copies of one another; rows that repeat id and text are one; different texts under one
    id both stay unless they are near; rows without an id stay; no rows: none.
    """
    return simhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the sentences of repeated spans; those left without words go, those that had none before stay.

    n_chars follows the text where it was cut. The first place, by doc_id, of a repeated span stays. Null texts and rows
    without an id stay as they are; repeated rows are cut alike; no rows: none.
    """
    out = next(c for c in map("repeats{}".format, range(len(docs.columns) + 1)) if c not in docs.columns)
    cleaned = spans.remove_repeats(docs, out=out)
    cut = F.col(f"{out}.n") > 0
    kept = cleaned.filter(~cut | F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    size = {"n_chars": F.when(cut, F.length("text").cast(f.dataType)).otherwise(F.col("n_chars")).alias("n_chars") for f in docs.schema if f.name == "n_chars"}
    return kept.select(*(size.get(c, F.col(f"`{c}`")) for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the calibrated draw keeps: half of the tokens, at tempered shares of source, language and topic.

    A null source or language is a level of its own; texts without tokens are kept with probability one half; rows
    without an id have no draw and go; repeated rows share their draw; no rows: none.
    """
    return mixing.sample(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their places in sequences of 2048 tokens.

    A null text is one piece, the end token; every row gives its own pieces; no rows: none.
    """
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are saved in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
