"""JSON loads, CSV lines and sheet values."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.validate import sanitized, sanitized_digits
from ..schemas import LISTING, MEASURES, STORED, TEXTS


def _first_sign(spark: SparkSession, path: str) -> str:
    """The first sign of a file that isn't white space, of its first 4096 bytes; '' without."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(where)
    try:
        head = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(spark.sparkContext._jvm.org.apache.commons.io.input.BoundedInputStream(stream, 4096))
    finally:
        stream.close()
    return bytes(head).decode("utf-8-sig", "replace").lstrip()[:1]


def load_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Listings of a file whose top level is an array; anything else fails. Missing and null fields are 0 or ''.

    An array is one value, which one task reads, so it has to fit there. lines: the path is a file, or a folder of files,
    with an object a line, which tasks read in parts whatever their size; other lines fail.
    """
    if not lines and _first_sign(spark, path) != "[":
        raise ValueError(f"{path}: the top level must be an array")
    rows = spark.read.schema(LISTING).option("multiLine", not lines).option("mode", "FAILFAST").json(path)
    return rows.select(*(F.coalesce(F.col(f.name), F.lit("" if f.name in TEXTS else 0).cast(f.dataType)).alias(f.name) for f in LISTING))


def csv_line() -> Column:
    """A listing's CSV line: sanitized, texts quoted, numbers bare."""
    quote = F.lit('"')
    cells = {f.name: sanitized_digits(f.name) if f.name in MEASURES else sanitized(f.name, False) for f in LISTING}
    texts = [k for k, f in enumerate(LISTING) if f.name in TEXTS]
    doubled = lambda x, k: F.when(k.isin(*texts), F.concat(quote, F.replace(x, quote, F.lit('""')), quote)).otherwise(x)
    # functions over arrays aren't compiled, so only lines with a quote in a text take the one that doubles them; the test names each text, for each to be computed once
    parts = [x for k, (name, cell) in enumerate(cells.items()) for x in ([F.lit(",")] if k else []) + ([quote, cell, quote] if name in TEXTS else [cell])]
    return F.when(F.concat(*(cells[c] for c in TEXTS)).contains(quote), F.array_join(F.transform(F.array(*cells.values()), doubled), ",")).otherwise(F.concat(*parts))


def write_csv(listings: DataFrame, folder: str, portal: str, ciudad: str = "medellin") -> str:
    """One file {portal}_arriendos_{ciudad}.csv with a byte-order mark, an unquoted header and CRLF line ends; it is replaced. Lines are streamed to the driver, never all held."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{portal}_arriendos_{ciudad}.csv")
    with open(path, "w", encoding="utf-8-sig", newline="") as out:
        out.write(",".join(f.name for f in LISTING) + "\r\n")
        for row in listings.select(csv_line().alias("line")).toLocalIterator():
            out.write(row["line"] + "\r\n")
    return os.path.abspath(path)


def write_csv_parts(listings: DataFrame, path: str) -> None:
    """The same lines as parts that the executors write under a path of any file system, for results that one file is too large for; ``path-header`` has the header. Names sort as the rows do, so the parts can be joined in that order."""
    listings.select(csv_line().alias("line")).write.mode("overwrite").option("lineSep", "\r\n").text(path)
    header = ",".join(f.name for f in LISTING)
    listings.sparkSession.range(1, numPartitions=1).select(F.lit("\ufeff" + header).alias("line")).write.mode("overwrite").option("lineSep", "\r\n").text(f"{path}-header")


def export_values(listings: DataFrame) -> DataFrame:
    """The 14 columns as a sheet takes them: missing texts '', missing numbers 0, the time as text."""
    kinds = {f.name: f.dataType for f in STORED}
    return listings.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c not in MEASURES else F.coalesce(F.col(c), F.lit(0)).cast(kinds[c]).alias(c) for c in kinds))
