"""Queries over listings: filters, merges, deduplication, the table's lifecycle, aggregates and order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions import validate
from ..operators import dedupe, lifecycle, merge
from ..sources.scratch import keep
from . import dataset as d
from .registry import Registry

query = Registry()
KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
PLAIN = ["id", "portal", "tipo", "precio", "area", "habitaciones", "banos", "parqueaderos", "estrato", "barrio", "url", "ciudad", "status", "scraped_at"]
_PLAIN = ", ".join(PLAIN)
_EXPORT = f"precio >= {fixed.EXPORT_LEAST} AND lower(tipo) IN ({', '.join(repr(t) for t in fixed.EXPORT_TIPOS)})"


def exportable(df: DataFrame) -> DataFrame:
    """Rows that are exported: price and type; their status makes no difference."""
    return df.filter((F.col("precio") >= fixed.EXPORT_LEAST) & F.lower("tipo").isin(*fixed.EXPORT_TIPOS))


def _made(df: DataFrame) -> DataFrame:
    """The same rows; filters aren't pushed below this, where what they ask for would be made again."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


@query(f"WITH {d.LST}, v AS (SELECT * REPLACE (CASE WHEN precio > 0 AND precio < 100000 THEN 0 ELSE precio END::BIGINT AS precio) FROM lst), t AS (SELECT *, 'active' AS status FROM v {d.LAST}) SELECT {_PLAIN} FROM t WHERE {_EXPORT} ORDER BY scraped_at DESC, id")
def exportable_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized, validated, the last of each id, exportable, newest first."""
    latest = validate.corrected(_made(d.latest(spark, sf_dir).drop(*KEYS))).withColumn("status", F.lit("active"))  # ids and order don't depend on what is corrected
    return keep(exportable(latest).select(*PLAIN), "exportable").orderBy(F.desc("scraped_at"), "id")  # a sort samples what it sorts: all would be made twice


@query(f"WITH {d.TBL} SELECT {_PLAIN} FROM tbl ORDER BY scraped_at DESC, id")
def listings_scan(spark, sf_dir):
    return d.stored(spark, sf_dir).select(*PLAIN).orderBy(F.desc("scraped_at"), "id")


@query(f"WITH {d.TBL} SELECT {_PLAIN} FROM tbl WHERE {_EXPORT}")
def export_filter(spark, sf_dir):
    return exportable(_made(d.stored(spark, sf_dir))).select(*PLAIN)


@query(f"WITH {d.TBL} SELECT {_PLAIN} FROM tbl WHERE {_EXPORT} AND lower(ciudad) = 'nation_3' AND lower(portal) = lower('ASIA') OR {_EXPORT} AND lower(ciudad) = 'nation_7'")
def export_filter_city(spark, sf_dir):
    city, portal = F.lower("ciudad"), F.lower("portal")
    return exportable(d.stored(spark, sf_dir)).filter(((city == "nation_3") & (portal == "asia")) | (city == "nation_7")).select(*PLAIN)


@query(f"WITH {d.OBS} SELECT {d.KEYS}, id FROM obs WHERE NOT contains(id, '-9')")
def stale_filter(spark, sf_dir):
    return d.observations(spark, sf_dir).filter(~F.col("id").contains("-9")).select(*KEYS, "id")


@query(f"WITH {d.OBS} SELECT {d.KEYS}, kind FROM (SELECT *, CASE raw_tipo WHEN 'Apto' THEN 'Apartamento' WHEN 'House' THEN 'Casa finca' ELSE lower(raw_tipo) END AS kind FROM obs) WHERE kind IN ('Apartamento', 'Casa', 'Casa finca')")
def residential_filter(spark, sf_dir):
    kind = F.when(F.col("raw_tipo") == "Apto", "Apartamento").when(F.col("raw_tipo") == "House", "Casa finca").otherwise(F.lower("raw_tipo"))
    return d.observations(spark, sf_dir).withColumn("kind", kind).filter(F.col("kind").isin(*fixed.RESIDENTIAL)).select(*KEYS, "kind")


@query(f"WITH {d.LST} SELECT {d.KEYS}, l_linenumber % 3 AS pass, tipo FROM lst WHERE l_linenumber % 3 <> 1 OR tipo = 'casa'")
def post_filter_type(spark, sf_dir):
    kind = F.col("l_linenumber") % 3
    return d.listings(spark, sf_dir).withColumn("pass", kind).filter((kind != 1) | (F.col("tipo") == "casa")).select(*KEYS, "pass", "tipo")


@query(f"WITH {d.LST} SELECT {d.KEYS}, ((barrio <> '')::INTEGER + (banos <> 0)::INTEGER + (habitaciones <> 0)::INTEGER + (estrato <> 0)::INTEGER) AS fields FROM lst WHERE ((barrio <> '')::INTEGER + (banos <> 0)::INTEGER + (habitaciones <> 0)::INTEGER + (estrato <> 0)::INTEGER) >= 2")
def structural_min(spark, sf_dir):
    said = (F.col("barrio") != "").cast("int") + sum((F.col(c) != 0).cast("int") for c in ("banos", "habitaciones", "estrato"))
    return d.listings(spark, sf_dir).withColumn("fields", said).filter("fields >= 2").select(*KEYS, "fields")


# --- merges: cards are listings, details are made of parts; some parts have none, some have two ---


def _details(spark, sf_dir):
    part = d.table(spark, sf_dir, "part").filter(F.col("p_partkey") % 4 != 0)
    rows = part.withColumn("pos", F.explode(F.when(F.col("p_partkey") % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    k, p = F.col("p_partkey"), F.col("pos")
    return rows.select(k.alias("l_partkey"), "pos", ((k + p) % 3 * 50).cast("int").alias("area"), ((k * p) % 4).cast("int").alias("estrato"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("Zona "), (k % 10).cast("string"))).alias("barrio"))


_DETAILS = """det AS (SELECT p_partkey AS l_partkey, ((p_partkey + pos) % 3 * 50)::INTEGER AS d_area, ((p_partkey * pos) % 4)::INTEGER AS d_estrato, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'Zona ' || (p_partkey % 10) END AS d_barrio
  FROM (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 2 ELSE 1 END AS pos FROM part WHERE p_partkey % 4 <> 0))"""
_FIELDS = ("area", "estrato", "barrio")


@query(f"WITH {d.LST}, {_DETAILS} SELECT {d.KEYS}, CASE WHEN d_area IS NULL THEN area ELSE d_area END AS area, CASE WHEN d_area IS NULL THEN estrato ELSE d_estrato END AS estrato, CASE WHEN d_area IS NULL THEN barrio ELSE d_barrio END AS barrio FROM lst LEFT JOIN det USING (l_partkey)")
def merge_overwrite(spark, sf_dir):
    return merge.overwrite(d.listings(spark, sf_dir).select(*KEYS, *_FIELDS), _details(spark, sf_dir), _FIELDS, key="l_partkey")


_FILLED = "coalesce(nullif(d_area, 0), area) AS area, coalesce(nullif(d_estrato, 0), estrato) AS estrato, coalesce(nullif(d_barrio, ''), barrio) AS barrio"


@query(f"WITH {d.LST}, {_DETAILS} SELECT {d.KEYS}, {_FILLED} FROM lst LEFT JOIN det USING (l_partkey)")
def merge_nonzero(spark, sf_dir):
    return merge.fill(d.listings(spark, sf_dir).select(*KEYS, *_FIELDS), _details(spark, sf_dir), _FIELDS, key="l_partkey")


@query(f"WITH {d.LST}, {_DETAILS}, n AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_suppkey, l_linenumber) AS nth FROM lst) SELECT {d.KEYS}, {_FILLED} FROM n LEFT JOIN det ON n.l_partkey = det.l_partkey AND nth = 1".replace("l_orderkey, l_partkey, l_suppkey, l_linenumber, coalesce", "l_orderkey, n.l_partkey, l_suppkey, l_linenumber, coalesce"))
def merge_first_match(spark, sf_dir):
    cards = d.listings(spark, sf_dir).select(*KEYS, *_FIELDS)
    return merge.fill_first(cards, _details(spark, sf_dir), _FIELDS, ["l_orderkey", "l_suppkey", "l_linenumber"], key="l_partkey")


_TOUCH = "count(*) FILTER (area > 0) AS areas, count(*) FILTER (estrato > 0) AS estratos, count(*) AS rows"


@query(f"WITH {d.LST}, {_DETAILS}, m AS (SELECT {_FILLED} FROM lst LEFT JOIN det USING (l_partkey)) SELECT {_TOUCH} FROM m")
def nonzero_counts(spark, sf_dir):
    return merge_nonzero(spark, sf_dir).agg(F.count_if(F.col("area") > 0).alias("areas"), F.count_if(F.col("estrato") > 0).alias("estratos"), F.count(F.lit(1)).alias("rows"))


@query(f"WITH {d.LST} SELECT count(*) FILTER (tipo <> '' AND area > 0 AND estrato > 0) AS complete, count(*) AS rows FROM lst")
def completeness(spark, sf_dir):
    whole = (F.col("tipo") != "") & (F.col("area") > 0) & (F.col("estrato") > 0)
    return d.listings(spark, sf_dir).agg(F.count_if(whole).alias("complete"), F.count(F.lit(1)).alias("rows"))


# --- deduplication ---


@query(f"WITH {d.LST} SELECT * FROM lst {d.FIRST}")
def dedupe_first(spark, sf_dir):
    return d.earliest(spark, sf_dir)


@query(f"WITH {d.LST} SELECT * FROM lst {d.LAST}")
def dedupe_last(spark, sf_dir):
    return d.latest(spark, sf_dir)


@query(f"WITH {d.LST} SELECT {d.KEYS}, id, count(*) OVER (PARTITION BY id, ciudad) > 1 AS repeated FROM lst")
def duplicate_flag(spark, sf_dir):
    return dedupe.mark_repeated(d.listings(spark, sf_dir), ["id", "ciudad"]).select(*KEYS, "id", "repeated")


# --- lifecycle: the table holds observations before 1998, the batch those of 1998 ---


def _before(spark, sf_dir):
    rows = d.observations(spark, sf_dir).filter(F.year("scraped_at") < 1998)
    return d.normalized(dedupe.last_wins(rows, ["id"], list(d.ORDER))).withColumn("status", F.lit("active")).select(*PLAIN)


def _batch(spark, sf_dir):
    return d.listings(spark, sf_dir).filter(F.year("scraped_at") == 1998)


_BATCHES = f"""{d.LST}, before AS (SELECT *, 'active' AS status FROM (SELECT * FROM lst WHERE year(scraped_at) < 1998 {d.LAST})), batch AS (SELECT * FROM lst WHERE year(scraped_at) = 1998),
  new AS (SELECT *, 'active' AS status FROM (SELECT * FROM batch {d.LAST})), scope AS (SELECT portal AS p, ciudad AS c FROM batch ORDER BY scraped_at, l_orderkey, l_partkey, l_suppkey, l_linenumber LIMIT 1)"""


@query(f"WITH {_BATCHES} SELECT {_PLAIN} FROM before WHERE id NOT IN (SELECT id FROM batch) UNION ALL SELECT {_PLAIN} FROM new")
def upsert_listings(spark, sf_dir):
    return lifecycle.upsert(_before(spark, sf_dir), _batch(spark, sf_dir), list(d.ORDER))


@query(f"WITH {_BATCHES} SELECT {_PLAIN} FROM (SELECT * REPLACE (CASE WHEN portal = 'asia' AND ciudad = 'nation_8' AND status = 'active' THEN 'inactive' ELSE status END AS status) FROM before)")
def deactivate_listings(spark, sf_dir):
    return lifecycle.deactivate(_before(spark, sf_dir), "asia", "nation_8")


@query(f"WITH {_BATCHES} SELECT {_PLAIN} FROM (SELECT * REPLACE (CASE WHEN portal = p AND ciudad = c THEN 'inactive' ELSE status END AS status) FROM before, scope) WHERE id NOT IN (SELECT id FROM batch) UNION ALL SELECT {_PLAIN} FROM new")
def snapshot_refresh(spark, sf_dir):
    return lifecycle.refresh(_before(spark, sf_dir), _batch(spark, sf_dir), list(d.ORDER))


@query(f"WITH {_BATCHES} SELECT {_PLAIN} FROM before WHERE id NOT IN (SELECT id FROM batch)")
def delisted(spark, sf_dir):
    return lifecycle.delisted(_before(spark, sf_dir), _batch(spark, sf_dir))


@query(f"WITH {_BATCHES} SELECT (SELECT count(*) FROM batch) AS batch_rows, count(*) AS new_rows, (SELECT count(*) FROM batch) - count(*) AS refreshed FROM new WHERE id NOT IN (SELECT id FROM before)")
def load_delta(spark, sf_dir):
    return lifecycle.load_delta(_before(spark, sf_dir), _batch(spark, sf_dir))


@query(f"WITH {d.LST} SELECT {d.KEYS}, portal, id FROM lst WHERE portal IN ('asia', 'europe')")
def union_portals(spark, sf_dir):
    rows = d.listings(spark, sf_dir).select(*KEYS, "portal", "id")
    return rows.filter("portal = 'asia'").unionByName(rows.filter("portal = 'europe'"))


# --- aggregates and order ---


@query("SELECT count(*) AS rows FROM lineitem")
def count_all(spark, sf_dir):
    return d.table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("rows"))


@query(f"WITH {d.TBL} SELECT portal, ciudad, count(*) FILTER (status = 'active') AS active, count(*) FILTER (status = 'inactive') AS inactive FROM tbl GROUP BY ALL")
def status_counts(spark, sf_dir):
    s = F.col("status")
    return d.stored(spark, sf_dir).groupBy("portal", "ciudad").agg(F.count_if(s == "active").alias("active"), F.count_if(s == "inactive").alias("inactive"))


@query(f"WITH {d.TBL} SELECT tipo, count(*) AS listings, count(DISTINCT barrio) AS barrios, min(precio) AS least, max(precio) AS most, count(*) FILTER (precio = 0) AS no_price FROM tbl GROUP BY ALL")
def scrape_report(spark, sf_dir):
    return d.stored(spark, sf_dir).groupBy("tipo").agg(F.count(F.lit(1)).alias("listings"), F.countDistinct("barrio").alias("barrios"), F.min("precio").alias("least"), F.max("precio").alias("most"), F.count_if(F.col("precio") == 0).alias("no_price"))


_ACTIVE = "portal = 'europe' AND ciudad = (SELECT min(ciudad) FROM tbl WHERE portal = 'europe') AND status = 'active'"


def _active(spark, sf_dir):
    europe = d.stored(spark, sf_dir, "EUR").filter("portal = 'europe'")  # ids begin with their portal's letters, which are known before the last of an id is picked
    city = europe.agg(F.min("ciudad").alias("_city"))
    return europe.join(F.broadcast(city), F.col("ciudad") == F.col("_city")).filter("status = 'active'")  # the city is one row


@query(f"WITH {d.TBL} SELECT id, tipo, precio, barrio, area FROM tbl WHERE {_ACTIVE} ORDER BY id")
def active_by_id(spark, sf_dir):
    return _active(spark, sf_dir).select("id", "tipo", "precio", "barrio", "area").orderBy("id")


@query(f"WITH {d.TBL}, a AS (SELECT id, precio, row_number() OVER (ORDER BY id) AS up, row_number() OVER (ORDER BY id DESC) AS down, count(*) OVER () AS n FROM tbl WHERE {_ACTIVE}) SELECT 'first' AS part, id, precio FROM a WHERE up <= 3 UNION ALL SELECT 'last', id, precio FROM a WHERE down <= 3 AND n > 3")
def head_tail_3(spark, sf_dir):
    rows = _active(spark, sf_dir).select("id", "precio")
    head = rows.orderBy("id").limit(3).select(F.lit("first").alias("part"), "id", "precio")
    many = rows.limit(4).agg((F.count(F.lit(1)) > 3).alias("_many"))
    tail = rows.orderBy(F.desc("id")).limit(3).crossJoin(F.broadcast(many)).filter("_many").select(F.lit("last").alias("part"), "id", "precio")
    return head.unionByName(tail)


@query(f"WITH {d.LST} SELECT id, portal, precio FROM lst ORDER BY scraped_at, {d.KEYS} LIMIT 3")
def sample_head(spark, sf_dir):
    return d.listings(spark, sf_dir).orderBy(*d.ORDER).limit(3).select("id", "portal", "precio")




@query(f"WITH {d.TBL} SELECT portal, tipo, count(*) AS listings, sum(precio)::BIGINT AS total FROM tbl GROUP BY CUBE (portal, tipo)")
def extension_cube(spark, sf_dir):
    return d.stored(spark, sf_dir).cube("portal", "tipo").agg(F.count(F.lit(1)).alias("listings"), F.sum("precio").alias("total"))


@query(f"WITH {d.TBL} SELECT portal, id, precio, rank() OVER (PARTITION BY portal ORDER BY precio DESC, id)::INTEGER AS nth FROM tbl QUALIFY nth <= 5")
def extension_top_prices(spark, sf_dir):
    nth = F.row_number().over(Window.partitionBy("portal").orderBy(F.desc("precio"), "id"))
    return d.stored(spark, sf_dir).withColumn("nth", nth).filter("nth <= 5").select("portal", "id", "precio", "nth")


QUERIES, ORACLES = query.queries, query.oracles
