"""Which pages a source has: enumerations as expressions, and driver loops where only the page itself can tell."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import number_in


def total_in_script(html: Column, name: str = "totalpagina") -> Column:
    """The number of pages that a script variable gives; 1 without."""
    return F.when(html.rlike(rf"var\s+{name}\s*=\s*[0-9]+"), number_in(html, rf"var\s+{name}\s*=\s*([0-9]+)")).otherwise(1)


def total_in_links(html: Column, pattern: str = r"/page/([0-9]+)/") -> Column:
    """The largest page number in the page's links; 1 without."""
    found = F.transform(F.regexp_extract_all(html, F.lit(pattern), 1), lambda x: x.try_cast("int"))
    return F.coalesce(F.greatest(F.array_max(found), F.lit(1)), F.lit(1))


def current_page(html: Column) -> Column:
    """The number that the first element of class ``current`` shows, which is the last page where a page far beyond it was asked for; 1 without."""
    return F.coalesce(shown_page(html), F.lit(1))


def shown_page(html: Column) -> Column:
    """As current_page, but null where the page shows no number."""
    shown = F.trim(F.regexp_extract(html, r"""<[a-zA-Z][^>]*\sclass\s*=\s*["'](?:[^"']*\s)?current(?:\s[^"']*)?["'][^>]*>(?:\s|<[^>]*>)*([^<]*)""", 1))
    number = F.when(shown.rlike("^[0-9]+$"), shown.try_cast("int"))
    return F.when(number.isNotNull(), F.greatest(number, F.lit(1)))


def numbered(df: DataFrame, total: Column, most: int | None = None) -> DataFrame:
    """A row for each page 1 .. total, at most ``most``."""
    count = F.least(total, F.lit(most)) if most else total
    return df.withColumn("page", F.explode(F.when(count >= 1, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))))


def offsets(df: DataFrame, total: Column, size: int = 200) -> DataFrame:
    """A row for each offset 0, size, ... below total; an empty source has none."""
    return df.withColumn("offset", F.explode(F.when(total > 0, F.sequence(F.lit(0), (total - 1).cast("int"), F.lit(size))).otherwise(F.array().cast("array<int>"))))


def by_kind(spark: SparkSession, kinds: Sequence[str], pages: DataFrame) -> DataFrame:
    """Every kind's pages; the kinds are a few literals."""
    return pages.withColumn("kind", F.explode(F.array(*map(F.lit, kinds))))


def until_empty(pages: DataFrame, source: Sequence[str], page: str = "page", cards: str = "cards") -> DataFrame:
    """Pages before the first that has no cards, of each source."""
    ends = pages.filter(F.col(cards) == 0).groupBy(*(F.col(c).alias(f"_of_{c}") for c in source)).agg(F.min(page).alias("_end"))
    same = reduce(Column.__and__, (pages[c].eqNullSafe(ends[f"_of_{c}"]) for c in source))
    kept = pages.join(ends, same, "left").filter(F.col("_end").isNull() | (F.col(page) < F.col("_end")))
    return kept.select(*(pages[c] for c in pages.columns))


def walk(fetch: Callable[[int], str | None], cards: Callable[[str], int], most: int | None = None, stop: str | None = None) -> Iterator[tuple[int, str]]:
    """Pages of a live source, one after another, until one fails, has the stop text, or has no cards."""
    page = 1
    while most is None or page <= most:
        html = fetch(page)
        if not html or (stop and stop in html) or not cards(html):
            return
        yield page, html
        page += 1


def fixpoint(count: Callable[[int], int], most_rounds: int = 100) -> tuple[int, int]:
    """Repeat an action until its count no longer grows: (last count, rounds)."""
    last = count(0)
    for k in range(1, most_rounds):
        now = count(k)
        if now <= last:
            return last, k
        last = now
    raise RuntimeError(f"the count still grew after {most_rounds} rounds")
