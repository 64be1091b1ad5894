"""The listings table in a relational database: reads in ranges with pushed filters, and upserts through a staging table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, url: str, table: str, column: str | None = None, parts: int = 8, properties: Mapping[str, str] | None = None) -> DataFrame:
    """A table; Spark pushes filters, columns and simple aggregates to the database. ``column``, a number or a time, splits it into ranges between its bounds, read by ``parts`` connections; rows where it is null are in the first."""
    options = {"url": url, "dbtable": table, **(properties or {})}
    if column is None:
        return spark.read.format("jdbc").options(**options).load()
    bounds = spark.read.format("jdbc").options(**{**options, "dbtable": f"(SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}) bounds"}).load().first()
    if bounds[0] is None:
        return spark.read.format("jdbc").options(**options).load()
    ranged = {"partitionColumn": column, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]), "numPartitions": str(parts)}
    return spark.read.format("jdbc").options(**options, **ranged).load()


def execute(spark: SparkSession, url: str, statements: Sequence[str], properties: Mapping[str, str] | None = None) -> None:
    """Run statements in one transaction: all of them take effect, or none."""
    jvm = spark.sparkContext._jvm
    own = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        own.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(url, own)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in statements:
            statement.execute(sql)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def upsert(rows: DataFrame, url: str, table: str, keys: Sequence[str], stage: str, properties: Mapping[str, str] | None = None, connections: int = 8) -> None:
    """Put rows into a table: those whose keys it has replace it, others are added.

    The executors fill a staging table, made with the table's own column types and a unique index on the keys, over a
    few connections; then one statement on the driver merges it. Readers see the table before or after, and a run that
    breaks off leaves it as it was: whatever it has staged is dropped by the next. Rows that share a key, or that a
    repeated task has staged twice, fail the run. Keys must not be null.
    """
    spark, names = rows.sparkSession, rows.columns
    quoted = [f'"{c}"' for c in names]
    with suppress(Exception):  # there usually is none
        execute(spark, url, [f"DROP TABLE {stage}"], properties)
    unique = ", ".join(f'"{k}"' for k in keys)
    execute(spark, url, [f"CREATE TABLE {stage} AS SELECT {', '.join(quoted)} FROM {table} WITH NO DATA", f"CREATE UNIQUE INDEX {stage}_keys ON {stage} ({unique})"], properties)
    rows.coalesce(connections).write.format("jdbc").options(url=url, dbtable=stage, **(properties or {})).mode("append").save()
    on = " AND ".join(f't."{k}" = s."{k}"' for k in keys)
    sets = ", ".join(f't."{c}" = s."{c}"' for c in names if c not in keys)
    merge = f"MERGE INTO {table} t USING {stage} s ON {on}" + (f" WHEN MATCHED THEN UPDATE SET {sets}" if sets else "")
    merge += f" WHEN NOT MATCHED THEN INSERT ({', '.join(quoted)}) VALUES ({', '.join(f's.{c}' for c in quoted)})"
    execute(spark, url, [merge, f"DROP TABLE {stage}"], properties)
