import prediolake
from prediolake.sources import catalog


def test_public_names():
    assert all(getattr(prediolake, name) is not None for name in prediolake.__all__)


def test_catalog(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS own LOCATION '{tmp_path}'")
    catalog.create(spark, "own.listings")
    catalog.create(spark, "own.listings")
    spark.sql("INSERT INTO own.listings (id, portal, ciudad) VALUES ('A', 'p', 'm'), ('B', 'q', 'm')")
    row = spark.table("own.listings").filter("id = 'A'").first()
    assert (row.precio, row.status, row.barrio, row.scraped_at) == (0, "active", "", None)
    assert catalog.count(spark.table("own.listings"), "active", ciudad="m") == 2 and catalog.count(spark.table("own.listings"), portal="x") == 0
    spark.sql("CREATE TABLE own.old (id string, portal string) USING parquet")
    assert "status" in catalog.widen(spark, "own.old") and catalog.widen(spark, "own.old") == []
    spark.sql("DROP DATABASE own CASCADE")


def test_search(spark):
    docs = spark.createDataFrame([(f"c{k}", "Apto en Belén" if k % 2 else "Casa", "medellin") for k in range(6)], "code string, title string, city string")
    assert [r.code for r in catalog.search(docs, "belén apto", 1, 1, city="medellin").collect()] == ["c3"]
    assert catalog.search(docs, city="x").count() == 0
