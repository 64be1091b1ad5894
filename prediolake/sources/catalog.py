"""The listings table in Spark's catalog: created with its defaults, widened where older versions lack columns, and counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MEASURES, STORED


def create(spark: SparkSession, name: str) -> None:
    """CREATE TABLE IF NOT EXISTS with the 14 columns, partitioned by portal, which is what an index on it would serve."""
    def default(field) -> str:
        if field.name in MEASURES:
            return " DEFAULT 0"
        return {"portal": "", "scraped_at": "", "status": " DEFAULT 'active'"}.get(field.name, " DEFAULT ''")

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}{default(f)}" for f in STORED)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (portal)")


def widen(spark: SparkSession, name: str) -> list[str]:
    """Add the columns that the table lacks; their names."""
    lacking = [f for f in STORED if f.name not in spark.table(name).columns]
    if lacking:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'{f.name} {f.dataType.simpleString()}' for f in lacking)})")
    return [f.name for f in lacking]


def get_all(table: DataFrame) -> DataFrame:
    """All rows, newest first, of one time by id."""
    return table.orderBy(F.desc("scraped_at"), "id")


def count(table: DataFrame, status: str | None = None, portal: str | None = None, ciudad: str | None = None) -> int:
    """Rows of a status, a portal and a city, as far as they are given."""
    for column, value in (("status", status), ("portal", portal), ("ciudad", ciudad)):
        if value is not None:
            table = table.filter(F.col(column) == value)
    return table.count()


def search(documents: DataFrame, words: str = "", offset: int = 0, limit: int = 200, order: str = "code", **equal: str) -> DataFrame:
    """A page of documents: all of the words in their text columns, equal fields, in the order of a column."""
    texts = [c for c, kind in documents.dtypes if kind == "string"]
    for word in words.lower().split():
        documents = documents.filter(F.lower(F.concat_ws(" ", *texts)).contains(word))
    for column, value in equal.items():
        documents = documents.filter(F.col(column) == value)
    return documents.orderBy(order).offset(offset).limit(limit)
