"""Queries over time and change: windows of a stream, as-of and range joins, what changed between scrapes, and page discovery. Spark-native extensions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tables
from ..operators import asof, changes, ranges, sketches
from ..sources import discovery, documents, partitions, scratch
from ..streaming import tracker, windows
from . import dataset as d
from . import listings
from .registry import Registry

query = Registry()

# --- a stream of events that arrive in chunks of five days: some a chunk late, some so late that their windows have closed ---

CHUNK_DAYS = 5
_CHUNK = f"CAST(floor(datediff(ts, '2024-01-01') / {CHUNK_DAYS}) AS INT)"
_ARRIVAL = f"CASE WHEN event_id % 50 = 7 AND ts < TIMESTAMP '2024-01-11' THEN {_CHUNK} + 3 WHEN event_id % 10 = 1 THEN {_CHUNK} + 1 ELSE {_CHUNK} END"
_CENTS = "CAST(round(value * 100) AS BIGINT)"


def _arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream: one batch for each chunk, in order. Files of a chunk are as many as its rows need."""
    events = d.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    dealt = events.withColumn("arrival", F.expr(_ARRIVAL))
    chunks = dealt.groupBy("arrival").agg(F.count(F.lit(1)).alias("n")).orderBy("arrival").collect()  # a few rows
    files = max(1, min((r.n for r in chunks), default=1) // 1_000_000)
    source = scratch.folder(spark, "arrivals")
    for r in chunks:
        dealt.filter(F.col("arrival") == r.arrival).drop("arrival").repartition(files).write.mode("append").parquet(source)
    return windows.arrivals(spark, source, events.schema, files)


def _closed(spark: SparkSession, result: DataFrame) -> DataFrame:
    target = scratch.folder(spark, "closed")
    windows.run(result, target, scratch.folder(spark, "progress"))
    plain = {c: F.col(c).cast("timestamp_ntz") for c in ("began", "ended")}  # as the tables have their times
    return spark.read.schema(result.schema).parquet(target).withColumns(plain)


_ON_TIME = "seen AS (SELECT *, round(value * 100)::BIGINT AS cents FROM events WHERE NOT (event_id % 50 = 7 AND ts < TIMESTAMP '2024-01-11')), mark AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY AS mark FROM events)"


@query(f"""WITH {_ON_TIME}, steps AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS step FROM seen WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
  named AS (SELECT *, sum(step) OVER (PARTITION BY user_id ORDER BY ts) AS nth FROM steps)
  SELECT user_id, min(ts) AS began, max(ts) + INTERVAL 6 HOUR AS ended, count(*) AS events, sum(cents)::BIGINT AS cents FROM named, mark GROUP BY user_id, nth, mark HAVING max(ts) + INTERVAL 6 HOUR <= mark""")
def event_sessions(spark, sf_dir):
    """Sessions of each user, closed by the watermark, with events that arrive out of order."""
    measures = (F.count(F.lit(1)).alias("events"), F.sum(F.expr(_CENTS)).alias("cents"))
    return _closed(spark, windows.sessions(_arriving(spark, sf_dir), "user_id", "ts", "6 hours", "1 day", measures))


@query(f"""WITH {_ON_TIME}, dealt AS (SELECT event_type, cents, unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 1 DAY, date_trunc('day', ts) - INTERVAL 2 DAY])::TIMESTAMP AS began FROM seen)
  SELECT event_type, began, began + INTERVAL 3 DAY AS ended, count(*) AS events, sum(cents)::BIGINT AS cents, max(cents) AS most FROM dealt, mark GROUP BY event_type, began, mark HAVING began + INTERVAL 3 DAY <= mark""")
def event_windows(spark, sf_dir):
    """Three days' totals of each kind of event, every day, closed by the watermark."""
    measures = (F.count(F.lit(1)).alias("events"), F.sum(F.expr(_CENTS)).alias("cents"), F.max(F.expr(_CENTS)).alias("most"))
    return _closed(spark, windows.sliding(_arriving(spark, sf_dir), ["event_type"], "ts", "3 days", "1 day", "1 day", measures))


@query("""WITH told AS (SELECT l_partkey, l_shipdate AS scraped_at, floor(l_quantity)::BIGINT AS after, l_orderkey * 10 + l_linenumber AS tie FROM lineitem WHERE l_partkey % 3 = 0),
  steps AS (SELECT *, lag(after) OVER (PARTITION BY l_partkey ORDER BY scraped_at, tie) AS before FROM told)
  SELECT l_partkey, scraped_at, before, after FROM steps WHERE before <> after""")
def value_changes(spark, sf_dir):
    """Each change of a listing's measure, told by a stream of its observations that comes a year at a time."""
    told = d.table(spark, sf_dir, "lineitem").filter(F.col("l_partkey") % 3 == 0).select("l_partkey", F.col("l_shipdate").cast("timestamp").alias("scraped_at"), F.floor("l_quantity").alias("after"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("tie"))
    dealt = told.withColumn("year", F.year("scraped_at"))
    years = dealt.groupBy("year").agg(F.count(F.lit(1)).alias("n")).orderBy("year").collect()  # a few rows
    files = max(1, min((r.n for r in years), default=1) // 1_000_000)
    source = scratch.folder(spark, "observations")
    for r in years:
        dealt.filter(F.col("year") == r.year).drop("year").repartition(files).write.mode("append").parquet(source)
    found = tracker.changes(windows.arrivals(spark, source, told.schema, files), "l_partkey", "scraped_at", "after", "tie")
    target = scratch.folder(spark, "changes")
    windows.run(found, target, scratch.folder(spark, "progress"))
    return spark.read.schema(found.schema).parquet(target).withColumn("scraped_at", F.col("scraped_at").cast("timestamp_ntz"))


# --- joins over time: a visit is an order, of the listing with its customer's number ---

_DAY = 86_400


def _visits(spark, sf_dir):
    return d.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("l_partkey"), F.col("o_orderdate").alias("visited"))


@query("""WITH seen AS (SELECT l_partkey, l_shipdate AS scraped_at, floor(l_extendedprice * 100)::BIGINT AS cents, l_suppkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_partkey, l_shipdate ORDER BY l_orderkey DESC, l_suppkey DESC, l_linenumber DESC) = 1)
  SELECT o_orderkey, o_custkey AS l_partkey, o_orderdate AS visited, coalesce(scraped_at, TIMESTAMP '1970-01-01') AS scraped_at, coalesce(cents, 0) AS cents, coalesce(seen.l_suppkey, 0) AS l_suppkey FROM orders ASOF LEFT JOIN seen ON o_custkey = l_partkey AND o_orderdate >= scraped_at""")
def price_at_visit(spark, sf_dir):
    """The price that a visitor saw: that of the listing's last observation at or before the visit; 0, of 1970, where there is none."""
    seen = d.table(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_shipdate").alias("scraped_at"), F.floor(F.col("l_extendedprice") * 100).alias("cents"), "l_suppkey", "l_orderkey", "l_linenumber")
    found = asof.asof(_visits(spark, sf_dir), seen, "l_partkey", "visited", "scraped_at", ["cents", "l_suppkey"], 365 * _DAY, ["l_orderkey", "l_suppkey", "l_linenumber"])
    return found.fillna(0, ["cents", "l_suppkey"]).withColumn("scraped_at", F.coalesce("scraped_at", F.lit("1970-01-01").cast("timestamp_ntz")))  # missing values are 0, as elsewhere


@query("""SELECT l_orderkey, l_linenumber, l_partkey, o_orderkey, (epoch(least(l_shipdate + to_days(l_linenumber * 7), o_orderdate + to_days((o_orderkey % 20)::INTEGER))) - epoch(greatest(l_shipdate, o_orderdate)))::BIGINT AS shared_seconds
  FROM lineitem JOIN orders ON l_partkey = o_custkey AND l_shipdate < o_orderdate + to_days((o_orderkey % 20)::INTEGER) AND o_orderdate < l_shipdate + to_days(l_linenumber * 7) WHERE o_orderkey % 20 > 0""")
def period_overlaps(spark, sf_dir):
    """Offers of a listing (weeks from an observation on) that share time with visits of it (some days each)."""
    days = lambda at, n: F.expr(f"timestampadd(DAY, {n}, {at})")
    offers = d.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").alias("offered"), days("l_shipdate", "l_linenumber * 7").alias("withdrawn"))
    stays = _visits(spark, sf_dir).select("o_orderkey", "l_partkey", "visited", days("visited", "CAST(o_orderkey % 20 AS INT)").alias("gone"))
    pairs = ranges.overlapping(offers, stays, ["l_partkey"], ("offered", "withdrawn"), ("visited", "gone"), 28 * _DAY)
    shared = F.unix_timestamp(F.least("withdrawn", "gone")) - F.unix_timestamp(F.greatest("offered", "visited"))
    return pairs.select("l_orderkey", "l_linenumber", "l_partkey", "o_orderkey", shared.alias("shared_seconds"))


# --- what changed between the scrapes of two years ---

_FACTS = ("portal", "tipo", "estrato")


def _year(spark, sf_dir, year):
    return d.listings(spark, sf_dir).filter(F.year("scraped_at") == year).select("id", *_FACTS)


_YEARS = f"{d.LST}, b AS (SELECT id, {', '.join(_FACTS)} FROM lst WHERE year(scraped_at) = 1996), a AS (SELECT id, {', '.join(_FACTS)} FROM lst WHERE year(scraped_at) = 1997)"


@query(f"WITH {_YEARS} SELECT *, 'removed' AS change FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) UNION ALL SELECT *, 'added' FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)")
def scrape_row_changes(spark, sf_dir):
    return changes.row_changes(_year(spark, sf_dir, 1996), _year(spark, sf_dir, 1997))


@query(f"WITH {_YEARS} SELECT * FROM b INTERSECT ALL SELECT * FROM a")
def scrape_kept_rows(spark, sf_dir):
    return changes.kept_rows(_year(spark, sf_dir, 1996), _year(spark, sf_dir, 1997))


@query(f"""WITH {_YEARS}, u AS (SELECT *, -1 AS s FROM b UNION ALL SELECT *, 1 FROM a), r AS (SELECT id, {', '.join(_FACTS)}, sum(s) AS s FROM u GROUP BY ALL),
  t AS (SELECT id, count(*) FILTER (s < 0) AS n_before, count(*) FILTER (s > 0) AS n_after FROM u GROUP BY id),
  f AS ({' UNION ALL '.join(f"SELECT id, '{c}' AS f FROM (SELECT id, {c}, sum(s) AS s FROM u GROUP BY id, {c} HAVING sum(s) <> 0) GROUP BY id" for c in _FACTS)}),
  g AS (SELECT id, string_agg(f, ',' ORDER BY f) AS fields FROM f GROUP BY id)
  SELECT id, CASE WHEN n_before = 0 THEN 'added' WHEN n_after = 0 THEN 'removed' ELSE 'changed' END AS change, n_before, n_after, coalesce(fields, '') AS fields
  FROM t LEFT JOIN g USING (id) WHERE id IN (SELECT id FROM r WHERE s <> 0)""")
def scrape_change_feed(spark, sf_dir):
    return changes.feed(_year(spark, sf_dir, 1996), _year(spark, sf_dir, 1997), ["id"], _FACTS)


# --- page discovery: page p of source s is the p-th of the pages with that remainder ---

SOURCES = 20


@query(f"SELECT source, count(*)::INTEGER AS pages FROM (SELECT page_id % {SOURCES} AS source FROM pages) GROUP BY source")
def page_discovery(spark, sf_dir):
    """How many pages each of twenty sources has, by probes alone. Even sources answer pages beyond their last with that one, the others with nothing."""
    stored = d.table(spark, sf_dir, "pages").select((F.col("page_id") % SOURCES).alias("source"), (F.floor(F.col("page_id") / SOURCES) + 1).cast("int").alias("page"))
    stored = stored.withColumn("html", F.format_string('<div class="card">%d</div><b class="current">%d</b>', F.col("page"), F.col("page")))
    last = stored.filter(F.col("source") % 2 == 0).groupBy("source").agg(F.max("page").alias("last"))

    def answers(asked: DataFrame) -> DataFrame:
        shown = asked.join(last, "source", "left").withColumn("shown", F.least("page", F.coalesce("last", F.col("page"))))
        return shown.join(stored.withColumnRenamed("page", "shown"), ["source", "shown"], "left").select("source", "page", "html")

    found = discovery.discover(stored, ["source"], answers, lambda html: html.contains('class="card"'))
    return found.select("source", "pages")


# --- a document source with pushed filters; documents are parts ---


def _documents(spark, sf_dir):
    k = F.col("p_partkey")
    return d.table(spark, sf_dir, "part").select(
        F.format_string("D%09d", k).alias("code"), F.lower("p_type").alias("property_type"), F.col("p_retailprice").alias("field_lease_value"), F.col("p_size").cast("double").alias("field_area"),
        (k % 5).cast("int").alias("field_bedrooms"), F.when(k % 3 == 0, (k % 4).cast("int")).alias("field_bathrooms"), F.lit(None).cast("int").alias("field_garages"), (k % 7).cast("int").alias("field_stratum"),
        F.col("p_name").alias("neighborhood"), F.concat(F.lit("/inmueble/"), k.cast("string")).alias("url"),
    )


@query("""SELECT code, property_type, field_lease_value, field_area, field_bedrooms, coalesce(field_bathrooms, 0) AS field_bathrooms, neighborhood, url FROM (
    SELECT format('D{:09d}', p_partkey) AS code, lower(p_type) AS property_type, p_retailprice AS field_lease_value, p_size::DOUBLE AS field_area, (p_partkey % 5)::INTEGER AS field_bedrooms,
    CASE WHEN p_partkey % 3 = 0 THEN (p_partkey % 4)::INTEGER END AS field_bathrooms, p_name AS neighborhood, '/inmueble/' || p_partkey AS url FROM part)
  WHERE property_type IN ('standard', 'large') AND field_bedrooms = 2 AND field_area > 10 AND contains(url, '1') ORDER BY code LIMIT 50 OFFSET 5""")
def document_search(spark, sf_dir):
    """A page of documents by equality, containment and a comparison: the first three filters are answered by the source, the last by Spark."""
    saved = scratch.folder(spark, "answers")
    documents.save_answers(_documents(spark, sf_dir), saved)
    found = documents.load(spark, saved).filter(F.col("property_type").isin("standard", "large") & (F.col("field_bedrooms") == 2) & (F.col("field_area") > 10) & F.col("url").contains("1"))
    return documents.page_of(found, 5, 50).select("code", "property_type", "field_lease_value", "field_area", "field_bedrooms", F.coalesce("field_bathrooms", F.lit(0)).alias("field_bathrooms"), "neighborhood", "url")


# --- the table in partitions ---


@query(listings.ORACLES["snapshot_refresh"])
def partition_refresh(spark, sf_dir):
    """The snapshot refresh in place: a catalog table whose touched partitions alone are rewritten."""
    name = f"listings_{uuid.uuid4().hex}"
    partitions.create(spark, name, scratch.folder(spark, "listings"))
    partitions.load(spark, name, listings._before(spark, sf_dir))
    partitions.refresh_partitions(spark, name, listings._batch(spark, sf_dir), list(d.ORDER))
    return spark.table(name).select(*listings.PLAIN)


# --- sketches of each year's scrape, stored, merged by portal and held against exact figures ---

_EXACT_NAMES = "portal, count(*) AS n, count(DISTINCT barrio) AS barrios"


@query(f"WITH {d.LST}, e AS (SELECT {_EXACT_NAMES}, true AS barrios_within, true AS quartiles_within FROM lst GROUP BY portal), c AS (SELECT portal, tipo, count(*) AS k FROM lst GROUP BY ALL), m AS (SELECT portal, max(k) AS most FROM c GROUP BY portal) SELECT e.*, most FROM e JOIN m USING (portal)")
def sketch_report(spark, sf_dir):
    """Exact figures of each portal, whether the merged sketches' distinct count is within 3 % and their quartiles within 2 % of rank, and the count of the most frequent type by the sketch."""
    rows = d.listings(spark, sf_dir).select("portal", F.year("scraped_at").alias("year"), "barrio", "precio", "tipo")
    stored = scratch.keep(sketches.sketch(rows, ["portal", "year"], "barrio", "precio", "tipo"), "sketches")
    told = sketches.estimates(sketches.merge(stored, ["portal"]), ["portal"]).withColumnsRenamed({"n": "told_n", "distinct": "told_distinct", "quantiles": "q"})
    joined = rows.join(F.broadcast(told.select("portal", "q")), "portal")  # a row for each portal
    ranks = [F.count_if(F.col("precio") < F.col("q")[k]).alias(f"below{k}") for k in range(3)] + [F.count_if(F.col("precio") <= F.col("q")[k]).alias(f"upto{k}") for k in range(3)]
    exact = joined.groupBy("portal").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("barrio").alias("barrios"), *ranks)
    near = F.abs(F.col("told_distinct") - F.col("barrios")) <= F.greatest(F.col("barrios") * 0.03, F.lit(1))
    within = F.lit(True)
    for k, share in enumerate((0.25, 0.5, 0.75)):
        within = within & (F.col(f"below{k}") <= (share + 0.02) * F.col("n")) & (F.col(f"upto{k}") >= (share - 0.02) * F.col("n"))
    return exact.join(told, "portal").filter("n = told_n").select("portal", "n", "barrios", near.alias("barrios_within"), within.alias("quartiles_within"), F.col("frequent")[0]["count"].alias("most"))


# --- cards by a table function in SQL ---


@query("SELECT p_partkey AS key, card::INTEGER AS card, CASE card WHEN 0 THEN 'menu' ELSE '$ ' || card || '|' || p_name END AS text FROM part, range(0, 3) t(card) WHERE card <= 1 + p_partkey % 2 AND NOT (card = 0 AND p_partkey % 5 = 0)")
def card_table_function(spark, sf_dir):
    """The cards of each page, split in SQL where a line begins with a price."""
    tables.register(spark)
    d.table(spark, sf_dir, "part").createOrReplaceTempView("parts_with_cards")
    pages = "SELECT p_partkey, posexplode(split(concat(if(p_partkey % 5 = 0, '', 'menu\n'), '$ 1\n', p_name, if(p_partkey % 2 = 1, concat('\n\n$ 2\n ', p_name), '')), '\n')) AS (pos, line) FROM parts_with_cards"
    return spark.sql(f"SELECT key, card, text FROM split_cards(TABLE({pages}), '[$] [0-9]')")


@query(f"WITH {d.LST} SELECT portal, count(*) AS listings, quantile_disc(precio // 1000, 0.5)::BIGINT AS thousands FROM lst WHERE precio > 0 GROUP BY portal")
def median_in_sql(spark, sf_dir):
    """The median price of each portal, in thousands, by an aggregate in Python over counted values: a portal's values are bounded by what prices there are."""
    tables.register(spark)
    d.listings(spark, sf_dir).createOrReplaceTempView("listings_with_prices")
    counted = "SELECT portal, precio DIV 1000 AS thousands, count(*) AS n FROM listings_with_prices WHERE precio > 0 GROUP BY ALL"
    return spark.sql(f"WITH counted AS ({counted}) SELECT * FROM (SELECT portal, sum(n) AS listings FROM counted GROUP BY portal) JOIN (SELECT portal, weighted_median(thousands, n) AS thousands FROM counted GROUP BY portal) USING (portal)")


QUERIES, ORACLES = query.queries, query.oracles
