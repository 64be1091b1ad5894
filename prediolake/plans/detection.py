"""Queries of field detection, of its checks, and of zeros that mean 'not published'."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import detect

from . import dataset as d
from .extraction import _part, _say
from .registry import Registry

query = Registry()

# Fields that a portal doesn't publish, so that their zeros say nothing of completeness.
NOT_PUBLISHED = {
    "arrendamientosdelnorte": ("banos", "parqueaderos", "estrato"),
    "arrendamientosvillacruz": ("estrato",),
    "habitamos": ("area", "estrato"),
}


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size * 100000 WHEN 1 THEN p_partkey * 1000 WHEN 2 THEN p_size ELSE 0 END::BIGINT AS precio FROM part")
def detect_price(spark, sf_dir):
    m, k = F.col("p_partkey") % 4, F.col("p_partkey")
    card = F.when(m == 0, _say("Venta $ 900.000.000 Arriendo: $ ", F.col("p_size"), "00.000")).when(m == 1, _say("COP ", k, ".000 / $ 5")).when(m == 2, _say("Canon mensual ", F.col("p_size"))).otherwise("A convenir")
    return _part(spark, sf_dir).select("p_partkey", detect.price(card).alias("precio"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size WHEN 1 THEN p_size ELSE 0 END::INTEGER AS area, CASE p_partkey % 4 WHEN 2 THEN 'other unit' WHEN 3 THEN 'zero area' ELSE '' END AS flag FROM part")
def detect_area(spark, sf_dir):
    m, s = F.col("p_partkey") % 4, F.col("p_size")
    card = F.when(m == 0, _say("Área ", s, " m²")).when(m == 1, _say(s, "MTS² útiles")).when(m == 2, _say(s, " hectáreas")).otherwise("0 m2")
    return _part(spark, sf_dir).select("p_partkey", detect.area(card).alias("area"), detect.area_flag(card).alias("flag"))


@query("SELECT p_partkey, (p_partkey % 9)::INTEGER AS habitaciones, (p_partkey % 5)::INTEGER AS banos, CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS parqueaderos, CASE WHEN p_partkey % 7 BETWEEN 1 AND 6 THEN (p_partkey % 7)::INTEGER ELSE 0 END AS estrato FROM part")
def detect_counts(spark, sf_dir):
    k = F.col("p_partkey")
    card = _say(k % 9, " Alcobas | BAÑOS: ", k % 5, " | ", F.when(k % 2 == 0, "Garaje 1").otherwise("sin más"), " | Apto Estrato ", k % 7)
    return _part(spark, sf_dir).select("p_partkey", *(detect.count(card, f).alias(f) for f in detect.COUNTS), detect.level(card).alias("estrato"))


@query(f"SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'casa' WHEN 1 THEN 'apartamento' ELSE 'oficina' END AS tipo, {d.title_sql('p_name')} AS barrio, 'NEW-' || CASE p_partkey % 3 WHEN 0 THEN 'A' || p_partkey WHEN 1 THEN p_partkey::VARCHAR ELSE 'row' || p_partkey END AS id FROM part")
def detect_names(spark, sf_dir):
    k = F.col("p_partkey")
    card = F.when(k % 3 == 0, _say("Tipo: House\nREF: A", k)).when(k % 3 == 1, "sin nada").otherwise("Foto de oficina en arriendo")
    card = F.concat(card, F.lit("\nBarrio : "), F.col("p_name"))
    url = F.when(k % 3 == 1, _say("https://x.co/apartamentos/", k, "/")).otherwise("https://x.co/fotos/")
    found = detect.generated_id("NEW", detect.code(card, url), _say("row", k))
    return _part(spark, sf_dir).select("p_partkey", detect.kind(card, url).alias("tipo"), detect.place(card).alias("barrio"), found.alias("id"))


@query(f"WITH {d.LST} SELECT portal, count(*) AS rows, count(*) FILTER (precio > 0) AS priced, count(*) FILTER (area BETWEEN 20 AND 10000) AS plausible_area, count(*) FILTER (habitaciones BETWEEN 0 AND 20) AS plausible_rooms, min(area) AS least_area, max(area) AS most_area FROM lst GROUP BY ALL")
def field_signals(spark, sf_dir):
    return d.listings(spark, sf_dir).groupBy("portal").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("precio") > 0).alias("priced"), F.count_if(F.col("area").between(20, 10_000)).alias("plausible_area"), F.count_if(F.col("habitaciones").between(0, 20)).alias("plausible_rooms"),
        F.min("area").alias("least_area"), F.max("area").alias("most_area"),
    )


def missing(portal: Column, fields: tuple[str, ...] = ("area", "habitaciones", "banos", "parqueaderos", "estrato")) -> Column:
    """How many of a listing's measures are 0, but for those that its portal doesn't publish."""
    out = F.lit(0)
    for f in fields:
        silent = [p for p, names in NOT_PUBLISHED.items() if f in names]
        out = out + ((F.col(f) == 0) & ~portal.isin(*silent)).cast("int")
    return out


_PORTAL = "CASE WHEN portal = 'asia' THEN 'habitamos' WHEN portal = 'africa' THEN 'arrendamientosdelnorte' ELSE portal END"


@query(f"""WITH {d.LST}, p AS (SELECT *, {_PORTAL} AS source FROM lst) SELECT source, sum((area = 0 AND source <> 'habitamos')::INTEGER + (habitaciones = 0)::INTEGER + (banos = 0 AND source <> 'arrendamientosdelnorte')::INTEGER
  + (parqueaderos = 0 AND source <> 'arrendamientosdelnorte')::INTEGER + (estrato = 0 AND source NOT IN ('habitamos', 'arrendamientosdelnorte'))::INTEGER)::BIGINT AS missing FROM p GROUP BY ALL""")
def genuine_completeness(spark, sf_dir):
    source = F.when(F.col("portal") == "asia", "habitamos").when(F.col("portal") == "africa", "arrendamientosdelnorte").otherwise(F.col("portal"))
    return d.listings(spark, sf_dir).withColumn("source", source).groupBy("source").agg(F.sum(missing(F.col("source"))).alias("missing"))


QUERIES, ORACLES = query.queries, query.oracles
