from datetime import datetime

import pytest
from pyspark.sql import functions as F

from prediolake.functions import validate
from prediolake.operators import dedupe, lifecycle, merge
from prediolake.schemas import LISTING, STORED
from prediolake.sources.store import ListingStore

NAMES = LISTING.names


def listing(**given):
    return {n: ("" if n in ("id", "portal", "tipo", "barrio", "url") else 0) for n in NAMES} | given


def frame(spark, *rows):
    return spark.createDataFrame([tuple(listing(**r)[n] for n in NAMES) for r in rows], LISTING)


def stored(spark, *rows):
    full = [listing(**r) | {"ciudad": "m", "status": "active", "scraped_at": datetime(2024, 1, 1)} | r for r in rows]
    return spark.createDataFrame([tuple(r[n] for n in STORED.names) for r in full], STORED)


def warnings(spark, **row):
    return validate.corrected(frame(spark, row)).first()


def test_rules(spark):
    low = warnings(spark, precio=50000)
    assert low["precio"] == 0 and len(low["warnings"]) == 1
    for precio, n in ((99999, 1), (100000, 0), (50000000, 0), (50000001, 1), (60_000_000, 1)):
        assert len(warnings(spark, precio=precio)["warnings"]) == n
    assert warnings(spark, estrato=7)["estrato"] == 7 and len(warnings(spark, estrato=7)["warnings"]) == 1
    assert "= 8" in warnings(spark, estrato=8)["warnings"][0] and len(warnings(spark, estrato=8)["warnings"]) == 1
    assert len(warnings(spark, parqueaderos=35)["warnings"]) == 1
    assert warnings(spark)["warnings"] == []
    cut = warnings(spark, barrio="Belen Código: 12")
    assert cut["barrio"] == "Belen" and len(cut["warnings"]) == 1
    assert len(warnings(spark, id="ABC1", url="/x")["warnings"]) == 2


def test_loader_rules(spark):
    r = validate.loaded(frame(spark, {"id": "Rent: $ 77", "portal": "coninsa", "barrio": "Poblado. Arriendo", "url": "https://en.habitamos.com.co/x", "tipo": "venta", "precio": 60_000_000})).first()
    assert (r["id"], r["barrio"], r["url"]) == ("CON-77", "Poblado", "https://habitamos.com.co/x")
    assert len(r["issues"]) == 4


def test_rules_settle(spark):
    once = validate.corrected(frame(spark, {"precio": 5, "barrio": "X codigo: 1"}))
    again = validate.corrected(once.drop("warnings"))
    assert again.first()["warnings"] == []


def test_merges(spark):
    cards = frame(spark, {"url": "u", "banos": 2}, {"url": "u", "banos": 3}, {"url": "v", "banos": 4}).withColumn("seq", F.monotonically_increasing_id())
    details = spark.createDataFrame([("u", 1, 9), ("u", 2, 0)], "url string, pos int, banos int")
    banos = lambda df: [r["banos"] for r in df.orderBy("seq").collect()]
    assert banos(merge.overwrite(cards, details, ["banos"])) == [0, 0, 4]
    assert banos(merge.fill(cards, details, ["banos"])) == [2, 3, 4]
    better = spark.createDataFrame([("u", 1, 9)], "url string, pos int, banos int")
    assert banos(merge.fill(cards, better, ["banos"])) == [9, 9, 4]
    assert banos(merge.fill_first(cards, better, ["banos"], ["seq"])) == [9, 3, 4]


def test_dedupe(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "id string, seq int, v string")
    assert {(r.id, r.v) for r in dedupe.first_wins(rows, ["id"], ["seq"]).collect()} == {("a", "x"), ("b", None)}
    assert {(r.id, r.v) for r in dedupe.last_wins(rows, ["id"], ["seq"]).collect()} == {("a", "y"), ("b", None)}
    assert [r.repeated for r in dedupe.mark_repeated(rows, ["id"]).orderBy("id", "seq").collect()] == [True, True, False]


def test_refresh(spark):
    table = stored(spark, {"id": "A", "portal": "p"}, {"id": "B", "portal": "p"}, {"id": "Z", "portal": "q"})
    batch = stored(spark, {"id": "B", "portal": "p", "precio": 7}, {"id": "C", "portal": "p"}, {"id": "", "portal": "p"}, {"id": "", "portal": "p"}).withColumn("seq", F.monotonically_increasing_id())
    at = F.lit(datetime(2025, 1, 1)).cast("timestamp")
    got = {r.id: (r.status, r.precio, r.scraped_at.year) for r in lifecycle.refresh(table, batch, ["seq"], at).collect()}
    assert got == {"A": ("inactive", 0, 2024), "B": ("active", 7, 2025), "C": ("active", 0, 2025), "Z": ("active", 0, 2024)}
    assert lifecycle.quarantine(batch).count() == 2
    parity = lifecycle.upsert(table, batch, ["seq"], at, drop_empty_ids=False)
    assert parity.filter("id = ''").count() == 1
    again = lifecycle.refresh(lifecycle.refresh(table, batch, ["seq"], at), batch, ["seq"], at)
    assert {(r.id, r.status) for r in again.collect()} == {(k, v[0]) for k, v in got.items()}


def test_refresh_without_scope(spark):
    table = stored(spark, {"id": "A", "portal": "p"})
    empty = stored(spark, {"id": "A", "portal": "p"}).filter("false").withColumn("seq", F.lit(1))
    assert [r.status for r in lifecycle.refresh(table, empty, ["seq"]).collect()] == ["active"]


def test_load_delta(spark):
    table = stored(spark, {"id": "A"})
    batch = stored(spark, {"id": "A"}, {"id": "B"}, {"id": "B"})
    r = lifecycle.load_delta(table, batch).first()
    assert (r.batch_rows, r.new_rows, r.refreshed) == (3, 1, 2)


def test_store(spark, tmp_path):
    store = ListingStore(spark, str(tmp_path / "t"))
    assert store.version() == 0 and store.read().count() == 0 and store.backup(str(tmp_path), "x") is None
    store.commit(lambda t: t.unionByName(stored(spark, {"id": "A", "portal": "p"})))
    with pytest.raises(Exception, match="boom"):
        store.commit(lambda t: t.withColumn("id", F.raise_error(F.lit("boom")).cast("string")))
    assert store.version() == 1 and [r.id for r in store.read().collect()] == ["A"]
    assert spark.read.parquet(store.backup(str(tmp_path), "x")).count() == 1


def test_failed_write_is_not_a_version(spark, tmp_path):
    store = ListingStore(spark, str(tmp_path / "t"))
    store.commit(lambda t: t.unionByName(stored(spark, {"id": "A", "portal": "p"})))
    assert store.alive() and store.version() == 1


def test_threshold(spark):
    runs = spark.createDataFrame([("alnago", True, 4, ""), ("x", True, 0, ""), ("coninsa", False, 9, "")], "portal string, ok boolean, listings int, error string")
    dim = spark.createDataFrame([("alnago", 5), ("coninsa", 150)], "portal string, min_listings int")
    got = {r.portal: r.warning for r in merge.thresholds(runs, dim).collect()}
    assert got == {"alnago": "alnago: 4 listings (min 5)", "x": None, "coninsa": "coninsa: FAILED — unknown error"}


def test_the_first_label_on_the_page_counts(spark):
    from prediolake.functions import lines

    pages = ["Codigo: b1\nCódigo: a1", "Código\na2\nCodigo: b2", "x\nCODIGO\n\nc3", "nothing", None]
    rows = spark.createDataFrame([(k, p) for k, p in enumerate(pages)], "k int, page string")
    found = rows.select("k", lines.detail_labels(lines.lines(F.col("page")))["codigo"].alias("c")).orderBy("k").collect()
    assert [r.c for r in found] == ["b1", "a2", "c3", "", ""]
