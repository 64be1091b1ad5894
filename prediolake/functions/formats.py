"""Formats: durations, counts read from console output, report boxes, sheet ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTH = 50


def _minutes(seconds: Column) -> Column:
    return F.concat(F.floor(seconds / 60).cast("string"), F.lit("m "), F.floor(seconds - F.floor(seconds / 60) * 60).cast("string"), F.lit("s"))


def duration(seconds: Column) -> Column:
    """0s below zero, tenths below a second, whole seconds (cut) below a minute, else minutes and seconds."""
    tenths = F.bround(seconds, 1).cast("decimal(10,1)").cast("string")
    return F.when(seconds < 0, "0s").when(seconds < 1, F.concat(tenths, F.lit("s"))).when(seconds < 60, F.concat(F.floor(seconds).cast("string"), F.lit("s"))).otherwise(_minutes(seconds))


def duration_rounded(seconds: Column) -> Column:
    """Whole seconds, halves to even, below a minute; else minutes and seconds (cut)."""
    return F.when(seconds < 60, F.concat(F.bround(seconds, 0).cast("bigint").cast("string"), F.lit("s"))).otherwise(_minutes(seconds))


def listing_count(output: Column) -> Column:
    """The number on the first line that says 'Sample: N' or 'Scraped N'; 0 without."""
    return F.coalesce(F.nullif(F.regexp_extract(output, r"(?m)^\s*(?:Sample: |Scraped )\s*([0-9]+)(?=\s|$)", 1), F.lit("")).try_cast("int"), F.lit(0))


def centred(text: Column) -> Column:
    """A line of the report's box, cut to 48 and centred in 50, the odd blank to the right."""
    cut = F.left(text, F.lit(WIDTH - 2))
    left = F.floor((F.lit(WIDTH) - F.length(cut)) / 2).cast("int")
    return F.concat(F.lit("║"), F.rpad(F.concat(F.repeat(F.lit(" "), left), cut), WIDTH, " "), F.lit("║"))


def result_line(ok: Column, portal: Column, detail: Column) -> Column:
    """A portal's line of the report: its mark and name to the left, the detail to the right."""
    label = F.concat(F.when(ok, "✅").otherwise("❌"), F.lit(" "), portal)
    room = F.lit(WIDTH - 2) - F.length(label) - F.length(detail)
    return F.concat(F.lit("║ "), label, F.repeat(F.lit(" "), F.greatest(room, F.lit(0)) + 1), detail, F.lit("║"))


def a1_range(rows: Column, columns: int = 14) -> Column:
    """The sheet range of a header and so many rows."""
    return F.concat(F.lit(f"A1:{chr(64 + columns)}"), (rows + 1).cast("string"))


def tab_name(name: Column) -> Column:
    """A tab's name in a range: quoted if it has anything but letters, digits and underscores."""
    return F.when(name.rlike(r"(?U)[^\w]"), F.concat(F.lit("'"), name, F.lit("'"))).otherwise(name)
