"""What the operators share: the shared folder, saved tables, row numbering and connected components."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Callable, Sequence
from contextlib import suppress

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_OWN: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; where that is unset, a folder of our own in a session on one machine (tests), and an error on a cluster."""
    context = spark.sparkContext
    base = context.getConf().get(_SETTING) or spark.conf.get(_SETTING, None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError(f"{_SETTING} must name a folder that the driver and all executors share")
        base = _OWN.get(context.applicationId)
        if base is None:
            base = _OWN[context.applicationId] = tempfile.mkdtemp(prefix="prediolake-")
    return f"{base.rstrip('/')}/prediolake-{context.applicationId}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared folder; it bears its application's id and can be swept with it where the session has ended."""
    with suppress(Exception):
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def save(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back.

    This cuts the lineage: what follows can be recomputed from files that outlive any executor. So the shuffles that
    made the table are of no more use, and Spark removes their files when it is written. The table is removed when the
    driver's Python ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    atexit.register(remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def through_arrow(df: DataFrame, of: Callable, schema: object, most_bytes: int = 4 << 20) -> DataFrame:
    """df.mapInArrow, with the session's Arrow batches bounded to ``most_bytes``: texts vary in length, so a bound of rows bounds no memory. A smaller bound of the session stays."""
    conf = df.sparkSession.conf
    if bytes_of(conf.get(_BATCH)) > most_bytes:
        conf.set(_BATCH, str(most_bytes))
    return df.mapInArrow(of, schema)


def bytes_of(size: str) -> int:
    """Bytes of a size in Spark's notation, like 64m or 67108864b."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def bucket(count: int | Column, *cols: Column | str) -> Column:
    """A bucket 0 .. count-1 that depends on the given columns alone."""
    return F.pmod(F.xxhash64(*cols), count if isinstance(count, Column) else F.lit(count)).cast("int")


def number_rows(df: DataFrame, groups: Sequence[str], order: Sequence[str], out: str, salts: int) -> DataFrame:
    """Add ``out``: numbers from 0 without gaps within each group.

    A group is dealt over ``salts`` buckets, each is numbered by itself, and the buckets' sizes give the offsets. So
    no task gets more than a salt's share of a group. df must be deterministic (a saved table).
    """
    salted = df.withColumn("_salt", bucket(salts, *order))
    sizes = salted.groupBy(*groups, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*groups, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*groups, "_salt").orderBy(*order)
    numbered = salted.withColumn("_at", F.row_number().over(within) - 1)
    return numbered.join(offsets, [*groups, "_salt"]).withColumn(out, (F.col("_before") + F.col("_at")).cast("long")).drop("_salt", "_at", "_before")


def salts_for(rows: int, groups: int, rows_per_task: int = 200_000) -> int:
    return max(16, -(-rows // max(1, groups * rows_per_task)))


def components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """Connected components of an undirected graph.

    edges: columns a, b (long). Returns (node, root): root is the smallest node reachable. Only nodes that have an
    edge appear; no edges: no rows. Each round takes the least label among the neighbours and then follows the label's
    own label, until no label changes: labels only fall, so it ends. The rounds are saved tables, so none is recomputed
    and nothing is sent to the driver but a count. The joins are plain equi-joins whose output goes straight to another
    exchange, so Spark can split a node that has very many neighbours.
    """
    links = edges.filter("a <> b").select("a", "b")
    both = save(links.union(links.select("b", "a")).distinct(), f"{tag}-edges")
    labels = save(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")), f"{tag}-labels")
    while True:
        near = both.join(labels, both.b == labels.node).select(F.col("a").alias("node"), "root")
        least = near.union(labels.select("node", "root")).groupBy("node").agg(F.min("root").alias("root"))
        jump = labels.select(F.col("node").alias("of"), F.col("root").alias("further"))
        moved = least.join(jump, least.root == jump.of, "left").select("node", F.least("root", "further").alias("root"))
        new = save(moved, f"{tag}-labels")
        changed = new.join(labels.withColumnRenamed("root", "was"), "node").filter("root <> was").limit(1).count()
        labels = new
        if not changed:
            return labels
