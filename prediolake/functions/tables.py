"""Functions for SQL: cards out of lines as a table function, and a weighted median as an aggregate."""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf, udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn


@udtf
class SplitCards:
    """split_cards(TABLE(lines), 'begins'): (key, card, text) of the cards in (key, pos, line), split where a line matches the pattern.

    The lines of a key come together, ordered by pos, which analyze asks for: a query needn't say PARTITION BY. Lines
    before the first beginning are card 0. Lines are stripped and joined by '|'; empty and null ones are left out, so a
    key without lines has no card. A key is a page: its lines, one after another, are all that is held.
    """

    @staticmethod
    def analyze(lines: AnalyzeArgument, begins: AnalyzeArgument) -> AnalyzeResult:
        if not lines.isTable or not isinstance(begins.value, str):
            raise ValueError("split_cards takes a table and a constant pattern")
        names = [f.name for f in lines.dataType.fields]
        if len(names) != 3:
            raise ValueError("split_cards takes a table of a key, a position and a line")
        schema = T.StructType([T.StructField("key", lines.dataType.fields[0].dataType), T.StructField("card", T.IntegerType()), T.StructField("text", T.StringType())])
        return AnalyzeResult(schema, partitionBy=[PartitioningColumn(names[0])], orderBy=[OrderingColumn(names[1])])

    def __init__(self):
        self.key, self.card, self.held, self.begins = None, 0, [], None

    def eval(self, row, begins):
        if self.begins is None:
            self.begins = re.compile(begins)
        key, _, line = row
        self.key = key
        line = (line or "").strip()
        if not line:
            return
        if self.begins.match(line):
            if self.held:
                yield self.key, self.card, "|".join(self.held)
                self.held = []
            self.card += 1
        self.held.append(line)

    def terminate(self):
        if self.held:
            yield self.key, self.card, "|".join(self.held)


@arrow_udf(T.LongType())
def weighted_median(values: pa.Array, weights: pa.Array) -> int:
    """weighted_median(value, n): the smallest of a group's values at which half of its rows are reached, each value standing for n rows.

    A task gets a group's rows together, so group equal values first: then they are as many as there are values. Nulls
    and values of no rows don't count; a group without others is null.
    """
    held = pa.table({"v": values, "n": weights}).drop_null().filter(pc.field("n") > 0).sort_by("v")
    if not held.num_rows:
        return None
    upto = pc.cumulative_sum(held["n"].cast(pa.int64())).to_numpy()
    return held["v"][int((2 * upto >= upto[-1]).argmax())].as_py()


def register(spark: SparkSession) -> None:
    """Make the functions known to SQL in this session."""
    spark.udtf.register("split_cards", SplitCards)
    spark.udf.register("weighted_median", weighted_median)
