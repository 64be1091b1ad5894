import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from prediolake.llm import queries, simhash, spans, toxicity
from prediolake.llm.common import save, table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_stages(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    columns = docs.columns
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = save(stage(spark, docs, SF), f"t-{name}")
        out[name] = (before, docs)
        assert name == "packing" or docs.columns == columns
    before, after = out["toxicity"]
    scores = {r.doc_id: r.score for r in toxicity.score_documents(before, labels).collect()}
    assert {r.doc_id for r in after.collect()} == {k for k, s in scores.items() if s < 0.5}
    before, after = out["near_copies"]
    assert sorted(r.doc_id for r in after.collect()) == sorted({r.component_id for r in simhash.simhash_components(before).collect()})
    before, after = out["repeats"]
    cleaned = {r.doc_id: r for r in spans.remove_repeats(before).collect()}
    kept = {r.doc_id: r for r in after.collect()}
    assert all(kept[k].text == cleaned[k].text and kept[k].n_chars == len(kept[k].text) for k in kept)
    assert all(cleaned[k].repeats.n and not cleaned[k].text.split() for k in cleaned.keys() - kept.keys())
    before, after = out["mixing"]
    assert {r.doc_id for r in after.collect()} <= set(kept)
    before, after = out["packing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}
    assert after.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


def test_stages_over_awkward_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "x y z", "en", "s", 5), (3, "some words here", None, "s", 15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = save(stage(spark, docs, SF), "t")
        kept[name] = [r.doc_id for r in docs.collect()]
    assert sorted(kept["toxicity"], key=str) == [1, 2, 2, 3, None]
    assert sorted(kept["near_copies"], key=str) == sorted(kept["repeats"], key=str) == [1, 3, None]  # null and empty texts are copies
    assert set(kept["mixing"]) <= {1, 3} and sorted(kept["packing"]) == sorted(kept["mixing"])


def test_stages_over_no_rows(spark):
    docs = table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = save(stage(spark, docs, SF), "t")
        assert out.isEmpty() and (name == "packing" or out.columns == docs.columns)
        docs = out


def test_mixing_oracle(spark):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = c.execute(queries.ORACLES["op2_mixing"]).df().sort_values("doc_id", ignore_index=True)
    got = queries.QUERIES["op2_mixing"](spark, SF).toPandas().sort_values("doc_id", ignore_index=True)[want.columns]
    assert got.equals(want.astype(got.dtypes))


def test_stages_over_clashing_columns_ties_and_a_very_long_text(spark):
    """Columns that bear the names of the stages' own stay as they are; of copies the smallest doc_id stays; a long text goes through whole."""
    extra = ("score", "component_id", "fp", "node", "root", "topic", "weight", "kept", "repeats", "removed", "probability", "n_tokens", "part", "shard", "row")
    long = " ".join(f"w{k * 7919 % 100_003}" for k in range(120_000))
    texts = [(9, "one two three four five six seven"), (4, "one two three four five six seven"), (5, "Another text. With two sentences."), (6, long), (7, long + " more"), (8, "a b c d e f g h i j k l m n o p")]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t), *(f"{c}-{k}" for c in extra)) for k, t in texts], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in extra))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = save(stage(spark, docs, SF), "t")
        assert docs.columns == columns
        rows = {r.doc_id: r for r in docs.collect()}
        assert all(r[c] == f"{c}-{k}" for k, r in rows.items() for c in extra)
        if name == "near_copies":
            assert set(rows) == {4, 5, 6, 8}
        if name in ("near_copies", "repeats"):
            assert rows[6].text == long and rows[6].n_chars == len(long)
    packed = corpus_pipeline.pack(spark, save(spark.createDataFrame([(6, long)], "doc_id long, text string"), "t"), SF).collect()
    assert sum(r.length for r in packed) > 120_000 and max(r.length for r in packed) == 2048
