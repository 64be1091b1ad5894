"""Mixing sources to target weights: iterative proportional fitting of token weights, then calibrated sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from string import ascii_lowercase, ascii_uppercase

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save

DIMENSIONS = ("source", "lang", "topic")
NONE = "(none)"
WORD = "[^\\x20\\x09-\\x0D]+"


def tokens(text: Column) -> Column:
    """Words of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _signs(text: Column, signs: str) -> Column:
    """How many of a text's signs are among those given."""
    return F.length(text) - F.length(F.translate(text, signs, ""))


def form_topic(text: Column, n_tokens: Column) -> Column:
    """A topic by the text's form, for tables that bear none: empty; symbols (a sign of #$%&* for each two words or more); shouting (more A-Z than a-z); brief (under 100 words); long (1000 words or more); prose."""
    signs, capitals, small = (_signs(text, x) for x in ("#$%&*", ascii_uppercase, ascii_lowercase))
    return (
        F.when(text.isNull() | (n_tokens == 0), "empty").when(2 * signs >= n_tokens, "symbols").when(capitals > small, "shouting")
        .when(n_tokens < 100, "brief").when(n_tokens >= 1000, "long").otherwise("prose")
    )


def _measures(docs: DataFrame, text_col: str, source_col: str, lang_col: str, topic_col: str | None) -> list[Column]:
    """source, lang, topic and n_tokens of a row of docs; a null source, language or topic is the level (none)."""
    text = docs[f"`{text_col}`"].cast("string")
    n = tokens(text)
    levels = (docs[f"`{source_col}`"], docs[f"`{lang_col}`"], docs[f"`{topic_col}`"] if topic_col else form_topic(text, n))
    return [*(F.coalesce(x.cast("string"), F.lit(NONE)).alias(c) for c, x in zip(DIMENSIONS, levels, strict=True)), n.alias("n_tokens")]


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic_col: str | None = None) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens) for each row; a null source, language or topic is the level (none)."""
    return docs.select(docs[f"`{id_col}`"].alias("doc_id"), *_measures(docs, text_col, source_col, lang_col, topic_col))


def _targets(sums: dict[str, float], given: Mapping[str, float] | None, temper: float, total: float) -> dict[str, float]:
    """Each level's target tokens: the given shares (levels not named get none), or shares to the power ``temper``."""
    raw = {k: (given.get(k, 0.0) if given is not None else v**temper if v > 0 else 0.0) for k, v in sorted(sums.items())}
    whole = sum(raw.values())
    return {k: total * v / whole if whole else 0.0 for k, v in raw.items()}


def rake_cells(cells: Sequence[tuple[str, str, str, int]], fraction: float, temper: float = 0.7, rounds: int = 20, targets: Mapping[str, Mapping[str, float]] | None = None) -> list[float]:
    """Expected kept tokens of each cell (source, lang, topic, tokens), by iterative proportional fitting.

    It begins with ``fraction`` of each cell. A round scales the cells to the target of each source, then of each
    language, then of each topic; no cell is ever asked for more tokens than it has, which keeps tokens/cell a
    probability. Cells without tokens get 0.
    """
    have = np.array([c[3] for c in cells], dtype=float)
    y = fraction * have
    levels = []
    for d, name in enumerate(DIMENSIONS):
        names, index = np.unique(np.array([c[d] for c in cells], dtype=object), return_inverse=True) if len(cells) else (np.array([]), np.array([], dtype=int))
        sums = dict(zip(names.tolist(), np.bincount(index, have, len(names)).tolist(), strict=True))
        want = _targets(sums, (targets or {}).get(name), temper, fraction * float(have.sum()))
        levels.append((index, np.array([want[k] for k in names.tolist()])))
    for _ in range(rounds):
        for index, want in levels:
            sums = np.bincount(index, y, len(want))
            y = np.minimum(have, y * np.divide(want, sums, out=np.zeros_like(want), where=sums > 0)[index])
    return y.tolist()


def _rake_frame(cells: DataFrame, fraction: float, temper: float, rounds: int, targets: Mapping[str, Mapping[str, float]] | None) -> DataFrame:
    """rake_cells as DataFrame operations, for more cells than the driver should hold."""
    spark = cells.sparkSession
    now = cells.withColumn("y", F.col("n_tokens") * F.lit(fraction))
    total = F.lit(float(cells.agg(F.sum("n_tokens")).first()[0] or 0) * fraction)
    for name in DIMENSIONS:
        given = (targets or {}).get(name)
        sums = cells.groupBy(name).agg(F.sum("n_tokens").cast("double").alias("_s"))
        if given is not None:
            shares = spark.createDataFrame([(k, float(v)) for k, v in given.items()], f"{name} string, _r double")
            sums = sums.join(shares, name, "left").withColumn("_r", F.coalesce("_r", F.lit(0.0)))
        else:
            sums = sums.withColumn("_r", F.when(F.col("_s") > 0, F.pow("_s", F.lit(temper))).otherwise(0.0))
        whole = sums.agg(F.sum("_r")).first()[0] or 0.0
        sums = sums.select(name, (total * F.col("_r") / F.lit(whole) if whole else F.lit(0.0)).alias(f"_w_{name}"))
        now = now.join(sums, name)
    now = save(now, "mix-cells")
    for _ in range(rounds):
        for name in DIMENSIONS:
            s = F.sum("y").over(Window.partitionBy(name))
            now = now.withColumn("y", F.least(F.col("n_tokens").cast("double"), F.when(s > 0, F.col("y") * F.col(f"_w_{name}") / s).otherwise(0.0)))
        now = save(now, "mix-round")
    return now.select(*DIMENSIONS, "n_tokens", "y")


def draw(id_col: Column, seed: str = "mix") -> Column:
    """A number in [0, 1) that depends on the id and the seed alone."""
    return F.conv(F.substring(F.md5(F.concat(id_col.cast("string"), F.lit(seed)).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _chances(cells: DataFrame, fraction: float, temper: float, rounds: int, targets: Mapping[str, Mapping[str, float]] | None, most_cells: int) -> tuple[DataFrame, bool]:
    """(source, lang, topic, _p) of each cell (a saved table with n_tokens), and whether they are few enough to be sent to all tasks."""
    spark = cells.sparkSession
    few = cells.limit(most_cells + 1).count() <= most_cells
    if few:
        held = [(r["source"], r["lang"], r["topic"], r["n_tokens"]) for r in cells.orderBy(*DIMENSIONS).collect()]
        raked = spark.createDataFrame([(*c, y) for c, y in zip(held, rake_cells(held, fraction, temper, rounds, targets), strict=True)], "source string, lang string, topic string, n_tokens long, y double")
    else:
        raked = _rake_frame(cells, fraction, temper, rounds, targets)
    return raked.select(*DIMENSIONS, F.when(F.col("n_tokens") > 0, F.col("y") / F.col("n_tokens")).alias("_p")), few


def calibrate(rows: DataFrame, fraction: float = 0.5, temper: float = 0.7, rounds: int = 20, targets: Mapping[str, Mapping[str, float]] | None = None, most_cells: int = 100_000) -> DataFrame:
    """Add weight and probability to measured rows (a saved table): what keeps ``fraction`` of all tokens at the target shares.

    weight: the cell's raked share of tokens over its share in the table; probability: the chance with which each of
    its documents is kept. Documents without tokens, which no marginal counts, get weight 0 and probability
    ``fraction``. Up to ``most_cells`` cells are raked on the driver and sent to all tasks; more of them, by
    DataFrame operations with the same result, joined by key (Spark splits a hot source's join).
    """
    cells = save(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("n_tokens")), "mix-sums")
    chance, few = _chances(cells, fraction, temper, rounds, targets, most_cells)
    out = rows.join(F.broadcast(chance) if few else chance, list(DIMENSIONS), "left")
    return out.withColumn("weight", F.coalesce(F.col("_p") / F.lit(fraction), F.lit(0.0))).withColumn("probability", F.coalesce("_p", F.lit(fraction))).drop("_p")


def sample(docs: DataFrame, fraction: float = 0.5, temper: float = 0.7, rounds: int = 20, targets: Mapping[str, Mapping[str, float]] | None = None, seed: str = "mix", most_cells: int = 100_000, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic_col: str | None = None) -> DataFrame:
    """The rows of docs, all columns, that mix() keeps.

    The texts are read twice, to count the cells and to draw, and not shuffled: a row's cell and draw depend on the
    row alone, and the cells' chances are sent to all tasks (beyond ``most_cells`` cells they are joined by key).
    """
    columns = (text_col, source_col, lang_col, topic_col)
    cells = save(docs.select(*_measures(docs, *columns)).groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("n_tokens")), "mix-sums")
    chance, few = _chances(cells, fraction, temper, rounds, targets, most_cells)
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), docs[f"`{id_col}`"].alias("doc_id"), *_measures(docs, *columns)[:-1])
    drawn = rows.join(F.broadcast(chance) if few else chance, list(DIMENSIONS), "left").filter(draw(F.col("doc_id"), seed) < F.coalesce("_p", F.lit(fraction)))
    return drawn.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def mix(docs: DataFrame, fraction: float = 0.5, temper: float = 0.7, rounds: int = 20, targets: Mapping[str, Mapping[str, float]] | None = None, seed: str = "mix", **columns: str | None) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, weight, probability, draw and kept (draw < probability) for each row of docs.

    targets: by dimension, shares by level; without, each level's share of tokens to the power ``temper``, which
    lifts small levels. Rows with a null id are never kept, as they have no draw; repeated rows share their draw. Other
    columns are left aside, whatever their names. An empty table gives no rows.
    """
    rows = calibrate(save(measured(docs, **columns), "mix-rows"), fraction, temper, rounds, targets)
    rows = rows.withColumn("draw", draw(F.col("doc_id"), seed))
    return rows.withColumn("kept", F.coalesce(F.col("draw") < F.col("probability"), F.lit(False)))


def oracle(fraction: float = 0.5, temper: float = 0.7, rounds: int = 20, seed: str = "mix") -> str:
    """DuckDB SQL for the rows of the mixing query."""
    word = "[^ \\t-\\r]+"
    count = lambda p: f"len(regexp_extract_all(text, '{p}'))"
    parts = [
        f"""m AS (SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang, text, coalesce({count(word)}, 0)::BIGINT AS n_tokens FROM documents)""",
        f"""r AS (SELECT doc_id, source, lang, n_tokens, CASE WHEN text IS NULL OR n_tokens = 0 THEN 'empty' WHEN 2 * {count('[#$%&*]')} >= n_tokens THEN 'symbols' WHEN {count('[A-Z]')} > {count('[a-z]')} THEN 'shouting' WHEN n_tokens < 100 THEN 'brief' WHEN n_tokens >= 1000 THEN 'long' ELSE 'prose' END AS topic FROM m)""",
        "c AS (SELECT source, lang, topic, sum(n_tokens)::BIGINT AS n FROM r GROUP BY ALL)",
    ]
    for d in DIMENSIONS:
        parts.append(f"s_{d} AS (SELECT {d}, sum(n)::DOUBLE AS s FROM c GROUP BY ALL)")
        parts.append(f"w_{d} AS (SELECT {d}, {fraction!r} * (SELECT sum(n)::DOUBLE FROM c) * (CASE WHEN s > 0 THEN pow(s, {temper!r}) ELSE 0 END) / (SELECT sum(CASE WHEN s > 0 THEN pow(s, {temper!r}) ELSE 0 END) FROM s_{d}) AS want FROM s_{d}")
    parts.append(f"y0 AS MATERIALIZED (SELECT c.*, w_source.want AS want_source, w_lang.want AS want_lang, w_topic.want AS want_topic, {fraction!r} * n AS y FROM c JOIN w_source USING (source) JOIN w_lang USING (lang) JOIN w_topic USING (topic))")
    k = 0
    for _ in range(rounds):
        for d in DIMENSIONS:
            k += 1
            parts.append(f"y{k} AS MATERIALIZED (SELECT * REPLACE (least(n::DOUBLE, CASE WHEN sum(y) OVER (PARTITION BY {d}) > 0 THEN y * want_{d} / sum(y) OVER (PARTITION BY {d}) ELSE 0 END) AS y) FROM y{k - 1})")
    parts.append(f"p AS (SELECT r.*, CASE WHEN y.n > 0 THEN y.y / y.n END AS p, ('0x' || substr(md5(doc_id::VARCHAR || '{seed}'), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS draw FROM r JOIN y{k} y USING (source, lang, topic))")
    body = ",\n".join(x + ")" if x.count("(") > x.count(")") else x for x in parts)
    return f"WITH {body}\nSELECT doc_id, source, lang, topic, n_tokens, round(coalesce(p / {fraction!r}, 0), 6) AS weight, round(coalesce(p, {fraction!r}), 6) AS probability, draw < coalesce(p, {fraction!r}) AS kept FROM p"
