"""How many pages each of many sources has, where only asking can tell: all sources advance together, one request each a round."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .pagination import shown_page
from .scratch import keep

#: Fixed value: the page beyond all others that a source is first asked for.
FAR = 9999
#: The largest page number that can be asked for.
LARGEST = 2**31 - 1


def discover(sources: DataFrame, keys: Sequence[str], answers: Callable[[DataFrame], DataFrame], has_cards: Callable[[Column], Column], far: int = FAR, fan: int = 8, most_rounds: int = 40) -> DataFrame:
    """(keys, pages, probes): the last page of each source that has cards, and how many requests told so; 0 pages where the first has none.

    answers: gives one (keys, page, html) for each row of a table of (keys, page) that it has an answer to; requests
    without one count as pages without cards. Each source is first asked for page ``far`` and for pages 1, 2, 4 and so
    on below it. One that answers that page, or one beyond it, with cards and shows an earlier page as the current one has
    shown its last page; a page that shows no number tells nothing of that kind. Of the others, pages are taken to end once: a round asks for ``fan`` - 1 pages between the last that had cards
    and the first that hadn't, or beyond the last where none has lacked them yet. So a source of n pages takes about
    1 + log(n) / log(fan) rounds; each is one join over the sources still open, whose states are saved. Sources with
    equal keys are one; no sources: no rows. A source that has cards on the largest page that can be asked for is an error.
    """
    state = sources.select(*keys).distinct().select(*keys, F.lit(0).alias("low"), F.lit(None).cast("int").alias("high"), F.lit(0).alias("probes"), F.lit(None).cast("int").alias("pages"))
    state = keep(state, "discovery")
    doubling = [2**k for k in range(far.bit_length()) if 2**k < far]
    for n in range(most_rounds):
        open_ = state.filter("pages IS NULL")
        if open_.isEmpty():
            return state.select(*keys, "pages", "probes")
        if n == 0:
            asks = F.array(*map(F.lit, [*doubling, far]))
        else:
            beyond = F.array_distinct(F.array(*(F.least(F.greatest("low", F.lit(1)).cast("long") * 2**k, F.lit(LARGEST)).cast("int") for k in range(1, fan))))
            between = F.array_distinct(F.array(*(F.col("low") + F.ceil((F.col("high") - F.col("low")) * k / fan).cast("int") for k in range(1, fan))))
            asks = F.filter(F.when(F.col("high").isNull(), beyond).otherwise(between), lambda page: F.col("high").isNull() | (page < F.col("high")))
        asked = open_.withColumn("page", F.explode(asks))
        found = answers(asked.select(*keys, "page")).select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("page").alias("_page"), F.col("html").alias("_html"))
        on = F.col("page") == F.col("_page")
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
        html = F.coalesce("_html", F.lit(""))
        hit, shown = F.coalesce(has_cards(html), F.lit(False)), shown_page(html)
        seen = asked.join(found, on, "left").select(*keys, "low", "high", "probes", "page", hit.alias("hit"), F.when(hit & (F.col("page") >= far) & (shown < F.col("page")), shown).alias("clamped"))
        moved = seen.groupBy(*keys).agg(
            F.greatest(F.max("low"), F.max(F.when(F.col("hit"), F.col("page")))).alias("low"), F.least(F.max("high"), F.min(F.when(~F.col("hit"), F.col("page")))).alias("high"),
            (F.max("probes") + F.count(F.lit(1)).cast("int")).alias("probes"), F.max("clamped").alias("clamped"),
        )
        endless = F.when(F.col("low") == LARGEST, F.raise_error(F.lit("a source has cards on every page that can be asked for")).cast("int"))
        done = F.coalesce("clamped", F.when(F.col("high") - F.col("low") <= 1, F.col("low")), endless)
        state = keep(moved.select(*keys, "low", "high", "probes", done.alias("pages")).unionByName(state.filter("pages IS NOT NULL")), "discovery")
    raise RuntimeError(f"pages of some sources were not found in {most_rounds} rounds")
