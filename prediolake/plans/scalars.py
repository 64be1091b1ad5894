"""Queries of the normalizers, validation rules and formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed
from ..functions import formats, normalize, validate
from ..functions.text import digits, look_up
from ..operators.merge import thresholds
from ..sources.files import csv_line, export_values
from . import dataset as d
from .registry import Registry

query = Registry()
KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def _raw(name: str, function):
    return lambda spark, sf_dir: d.observations(spark, sf_dir).select(*KEYS, function(F.col(f"raw_{name}")).alias(name))


for _name, _field, _function, _sql in (
    ("normalize_price", "precio", normalize.price, d.price_sql), ("normalize_tipo", "tipo", normalize.tipo, d.tipo_sql), ("normalize_estrato", "estrato", normalize.estrato, d.estrato_sql),
    ("normalize_garaje", "garaje", normalize.garaje, d.garaje_sql), ("normalize_barrio", "barrio", normalize.barrio, d.barrio_sql), ("normalize_url", "url", lambda c: normalize.url(c, d.BASE), d.url_sql),
):
    query.queries[_name] = _raw(_field, _function)
    query.oracles[_name] = f"WITH {d.OBS} SELECT {d.KEYS}, {_sql('raw_' + _field)} AS {_field} FROM obs"


@query(f"WITH {d.OBS} SELECT {d.KEYS}, regexp_replace(raw_precio, '[^0-9]', '', 'g') AS digits FROM obs")
def digits_only(spark, sf_dir):
    return d.observations(spark, sf_dir).select(*KEYS, digits(F.col("raw_precio")).alias("digits"))


@query("SELECT n_nationkey, city, replace(replace(replace(replace(replace(replace(city, ' ', '%20'), 'í', '%C3%AD'), 'á', '%C3%A1'), '_', '_'), '+', '%2B'), ',', '%2C') AS encoded FROM (SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'Medellín' WHEN 1 THEN 'Bogotá' WHEN 2 THEN 'San Juan/' || n_name ELSE n_name END AS city FROM nation)")
def encode_city(spark, sf_dir):
    n = F.col("n_nationkey") % 4
    raw = F.when(n == 0, "medellin").when(n == 1, " BOGOTÁ ").when(n == 2, F.concat(F.lit("San Juan/"), F.col("n_name"))).otherwise(F.col("n_name"))
    name = F.trim(look_up(fixed.CITIES, F.lower(F.trim(raw)), raw))
    return d.table(spark, sf_dir, "nation").select("n_nationkey", name.alias("city"), normalize.encode_city(raw).alias("encoded"))


@query("SELECT p_partkey, regexp_replace(replace(lower(p_name || ' ñ_' || p_type || '!'), ' ', '-'), '[^\\p{L}\\p{N}-]', '', 'g') AS slug FROM part")
def url_slug(spark, sf_dir):
    return d.table(spark, sf_dir, "part").select("p_partkey", normalize.slug(F.concat("p_name", F.lit(" ñ_"), "p_type", F.lit("!"))).alias("slug"))


_BAD_ID = "CASE l_orderkey % 4 WHEN 0 THEN 'Rent: $' || l_partkey WHEN 1 THEN 'SALE: x' WHEN 2 THEN '' ELSE id END"


@query(f"WITH {d.OBS}, b AS (SELECT {d.KEYS}, portal, {_BAD_ID} AS bad FROM obs) SELECT {d.KEYS}, CASE WHEN (contains(lower(bad), 'rent:') OR contains(lower(bad), 'sale:') OR contains(bad, '$')) AND regexp_extract(bad, '([0-9]+)', 1) <> '' THEN upper(left(portal, 3)) || '-' || regexp_extract(bad, '([0-9]+)', 1) ELSE bad END AS id FROM b")
def repair_id(spark, sf_dir):
    o = F.col("l_orderkey") % 4
    bad = F.when(o == 0, F.concat(F.lit("Rent: $"), F.col("l_partkey").cast("string"))).when(o == 1, "SALE: x").when(o == 2, "").otherwise(F.col("id"))
    return d.observations(spark, sf_dir).select(*KEYS, normalize.repair_id(bad, F.col("portal")).alias("id"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'https://habitamos.com.co/' ELSE 'https://x.co/' END || p_partkey AS url FROM part")
def repair_url(spark, sf_dir):
    url = F.concat(F.when(F.col("p_partkey") % 2 == 0, "https://en.habitamos.com.co/").otherwise("https://x.co/"), F.col("p_partkey").cast("string"))
    return d.table(spark, sf_dir, "part").select("p_partkey", normalize.repair_url(url).alias("url"))


@query("SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '([?&])ref=[^&#]*', '\\1', 'g'), '([?&])&+', '\\1', 'g'), '[?&]+(#|$)', '\\1', 'g') AS url FROM pages")
def strip_query_param(spark, sf_dir):
    return d.table(spark, sf_dir, "pages").select("page_id", normalize.strip_parameter(F.col("url"), "ref").alias("url"))


@query("SELECT p_partkey, 'MXB-' || p_partkey AS code_id, CASE WHEN p_size % 5 = 0 THEN '' ELSE 'AVC-' || p_size END AS optional_id FROM part")
def compose_id(spark, sf_dir):
    code = F.when(F.col("p_size") % 5 == 0, "").otherwise(F.col("p_size").cast("string"))
    return d.table(spark, sf_dir, "part").select("p_partkey", normalize.compose_id("MXB", F.col("p_partkey"), True).alias("code_id"), normalize.compose_id("AVC", code).alias("optional_id"))


_SECONDS = "(e.event_id % 4000) / 8.0 - 10"


@query(f"""SELECT event_id, CASE WHEN s < 0 THEN '0s' WHEN s < 1 THEN {d.case('s', {0.0: '0.0s', 0.125: '0.1s', 0.25: '0.2s', 0.375: '0.4s', 0.5: '0.5s', 0.625: '0.6s', 0.75: '0.8s', 0.875: '0.9s'})}
  WHEN s < 60 THEN floor(s)::INTEGER || 's' ELSE floor(s / 60)::INTEGER || 'm ' || floor(s - 60 * floor(s / 60))::INTEGER || 's' END AS took FROM (SELECT event_id, {_SECONDS} AS s FROM events e)""")
def format_time(spark, sf_dir):
    return d.table(spark, sf_dir, "events").select("event_id", formats.duration((F.col("event_id") % 4000) / 8.0 - 10).alias("took"))


@query(f"SELECT event_id, CASE WHEN s < 60 THEN round_even(s, 0)::BIGINT || 's' ELSE floor(s / 60)::INTEGER || 'm ' || floor(s - 60 * floor(s / 60))::INTEGER || 's' END AS took FROM (SELECT event_id, {_SECONDS} AS s FROM events e)")
def format_time_round(spark, sf_dir):
    return d.table(spark, sf_dir, "events").select("event_id", formats.duration_rounded((F.col("event_id") % 4000) / 8.0 - 10).alias("took"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN user_id::INTEGER WHEN 1 THEN (event_id % 50)::INTEGER ELSE 0 END AS n FROM events")
def parse_listing_count(spark, sf_dir):
    k, user, other = F.col("event_id") % 4, F.col("user_id").cast("string"), (F.col("event_id") % 50).cast("string")
    output = F.when(k == 0, F.concat(F.lit("log\n  Sample: "), user, F.lit(" listing(s) extracted\nScraped 9 listings"))).when(k == 1, F.concat(F.lit("Scraped "), other, F.lit(" listings from x"))).when(k == 2, "Sample: many").otherwise("none")
    return d.table(spark, sf_dir, "events").select("event_id", formats.listing_count(output).alias("n"))


@query("SELECT c_custkey, 'A1:N' || (c_custkey + 1) AS cells, CASE WHEN c_custkey % 2 = 0 THEN '''' || c_mktsegment || ' 1''' ELSE c_mktsegment END AS tab FROM customer")
def a1_range(spark, sf_dir):
    name = F.when(F.col("c_custkey") % 2 == 0, F.concat("c_mktsegment", F.lit(" 1"))).otherwise(F.col("c_mktsegment"))
    return d.table(spark, sf_dir, "customer").select("c_custkey", formats.a1_range(F.col("c_custkey")).alias("cells"), formats.tab_name(name).alias("tab"))




@query(f"WITH {d.OBS} SELECT {d.KEYS}, coalesce({d.case('lower(raw_tipo)', fixed.TIPO)}, 'other') AS kind, coalesce({d.case('lower(raw_garaje)', fixed.GARAJE)}, -1)::INTEGER AS places FROM obs")
def lookup_join(spark, sf_dir):
    return d.observations(spark, sf_dir).select(*KEYS, look_up(fixed.TIPO, F.lower("raw_tipo"), F.lit("other")).alias("kind"), look_up(fixed.GARAJE, F.lower("raw_garaje"), F.lit(-1)).alias("places"))


def _dirty(spark, sf_dir):
    """Listings with faults that the rules know."""
    k = F.col("l_orderkey") % 7
    return d.listings(spark, sf_dir).withColumns(
        {
            "estrato": F.when(k == 0, 8).when(k == 1, 9).otherwise(F.col("estrato")), "barrio": F.when(k == 2, F.concat(F.col("barrio"), F.lit(" Código: 12"))).when(k == 3, "").otherwise(F.col("barrio")),
            "id": F.when(k == 4, "ABC").when(k == 5, "").otherwise(F.col("id")), "tipo": F.when(k == 6, "Venta").otherwise(F.col("tipo")),
        }
    )


_DIRTY = f"""{d.LST}, dirty AS (SELECT * REPLACE (CASE l_orderkey % 7 WHEN 0 THEN 8 WHEN 1 THEN 9 ELSE estrato END AS estrato, CASE l_orderkey % 7 WHEN 2 THEN barrio || ' Código: 12' WHEN 3 THEN '' ELSE barrio END AS barrio,
  CASE l_orderkey % 7 WHEN 4 THEN 'ABC' WHEN 5 THEN '' ELSE id END AS id, CASE l_orderkey % 7 WHEN 6 THEN 'Venta' ELSE tipo END AS tipo) FROM lst)"""
_STANDARD = ", ".join(f"'{t}'" for t in fixed.STANDARD_TIPOS)
_WARN = f"""array_to_string(list_filter([
  CASE WHEN precio > 0 AND precio < 100000 THEN 'precio=' || precio || ' set to 0 (below floor)' WHEN precio > 50000000 THEN 'precio=' || precio || ' unusually high' END,
  CASE WHEN contains(lower(barrio), 'código:') OR contains(lower(barrio), 'codigo:') THEN 'barrio=''' || barrio || ''' salvaged to first segment' END,
  CASE WHEN estrato = 8 THEN 'estrato=8 = 8 (commercial?)' WHEN estrato > 6 THEN 'estrato=' || estrato || ' > 6 (source data error)' END,
  CASE WHEN parqueaderos > 10 THEN 'parqueaderos=' || parqueaderos || ' > 10 (anomaly)' END, CASE WHEN habitaciones > 30 THEN 'habitaciones=' || habitaciones || ' suspiciously high' END,
  CASE WHEN banos > 20 THEN 'banos=' || banos || ' suspiciously high' END, CASE WHEN area > 10000 THEN 'area=' || area || ' suspiciously high' END,
  CASE WHEN tipo <> '' AND lower(tipo) NOT IN ({_STANDARD}) THEN 'tipo=''' || tipo || ''' non-standard' END,
  CASE WHEN id <> '' AND NOT contains(id, '-') THEN 'id=''' || id || ''' invalid format' END,
  CASE WHEN url <> '' AND NOT (url LIKE 'http://%' OR url LIKE 'https://%') THEN 'url=''' || url || ''' invalid format' END], lambda x: x IS NOT NULL), '; ')"""


@query(f"WITH {_DIRTY} SELECT {d.KEYS}, {_WARN} AS warnings FROM dirty")
def validate_rules(spark, sf_dir):
    return _dirty(spark, sf_dir).select(*KEYS, F.array_join(validate.warnings(), "; ").alias("warnings"))


@query(f"WITH {_DIRTY} SELECT {d.KEYS}, CASE WHEN precio > 0 AND precio < 100000 THEN 0 ELSE precio END::BIGINT AS precio, CASE WHEN contains(barrio, 'Código:') THEN split_part(barrio, ' ', 1) ELSE barrio END AS barrio FROM dirty")
def validate_corrected(spark, sf_dir):
    return validate.corrected(_dirty(spark, sf_dir)).select(*KEYS, "precio", "barrio")


@query(f"WITH {_DIRTY} SELECT sum(len(string_split({_WARN}, '; ')))::BIGINT AS anomalies FROM dirty WHERE {_WARN} <> ''")
def anomaly_count(spark, sf_dir):
    return _dirty(spark, sf_dir).agg(F.sum(F.size(validate.warnings())).alias("anomalies"))


@query(f"WITH {_DIRTY} SELECT count(*) FILTER ({_WARN} <> '') AS anomalous FROM dirty")
def anomaly_rows(spark, sf_dir):
    return _dirty(spark, sf_dir).agg(F.count_if(F.size(validate.warnings()) > 0).alias("anomalous"))


_ISSUES = """array_to_string(list_filter([
  CASE WHEN precio > 0 AND precio < 100000 THEN 'precio=' || precio || ' too low → 0' END, CASE WHEN precio > 500000000 THEN 'precio=' || format('{:,}', precio) || ' unusually high' END,
  CASE WHEN area > 10000 THEN 'area=' || area || ' unusually high' END, CASE WHEN habitaciones > 30 THEN 'habitaciones=' || habitaciones || ' > 30' END, CASE WHEN banos > 20 THEN 'banos=' || banos || ' > 20' END,
  CASE WHEN parqueaderos > 10 THEN 'parqueaderos=' || parqueaderos || ' > 10' END, CASE WHEN estrato > 6 THEN 'estrato=' || estrato || ' > 6 (Colombia max)' END,
  CASE WHEN barrio = '' THEN 'barrio is empty' WHEN regexp_matches(lower(barrio), 'código|code:|arriendo|\\$|rent:') THEN 'barrio contains artifacts: ' || left(barrio, 60) END,
  CASE WHEN url <> '' AND url NOT LIKE 'http%' THEN 'url not absolute: ' || left(url, 50) END, CASE WHEN contains(url, 'en.habitamos') THEN 'url has en. subdomain' END, CASE WHEN url = '' THEN 'url is empty' END,
  CASE WHEN id = '' THEN 'id is empty' WHEN regexp_matches(lower(id), 'rent:|sale:|\\$') THEN 'id contains price artifacts: ' || id END,
  CASE WHEN tipo = '' THEN 'tipo is empty' WHEN tipo IN ('arriendo', 'venta', 'for lease', 'for sale') THEN 'tipo is transaction type, not property type: ' || tipo END], lambda x: x IS NOT NULL), '; ')"""


@query(f"WITH {_DIRTY} SELECT {d.KEYS}, {_ISSUES} AS issues, CASE WHEN precio > 0 AND precio < 100000 THEN 0 ELSE precio END::BIGINT AS precio, CASE WHEN contains(lower(barrio), 'código') THEN trim(split_part(barrio, '.', 1)) ELSE barrio END AS barrio FROM dirty")
def loader_rules(spark, sf_dir):
    return validate.loaded(_dirty(spark, sf_dir)).select(*KEYS, F.array_join("issues", "; ").alias("issues"), "precio", "barrio")


@query(f"WITH {_DIRTY}, f AS (SELECT id, {d.KEYS}, {_ISSUES} AS issues FROM dirty), b AS (SELECT * FROM f WHERE issues <> '') SELECT id, issues, greatest((SELECT count(*) FROM b) - 5, 0)::BIGINT AS more FROM (SELECT * FROM b ORDER BY {d.KEYS} LIMIT 5)")
def flagged_preview(spark, sf_dir):
    found = F.explode(F.array(F.array_join(validate.issues(), "; ")))  # a filter isn't pushed below it, where each of its columns would be made again for every rule
    flagged = _dirty(spark, sf_dir).select("id", *KEYS, found.alias("issues")).filter("issues <> ''")
    total = flagged.agg(F.greatest(F.count(F.lit(1)) - 5, F.lit(0)).alias("more"))
    return flagged.orderBy(*KEYS).limit(5).crossJoin(F.broadcast(total)).select("id", "issues", "more")  # the total is one row


_MESSY = "CASE l_orderkey % 6 WHEN 0 THEN 'N/A' WHEN 1 THEN '12.0' WHEN 2 THEN ' 12 ' WHEN 3 THEN 'null' WHEN 4 THEN NULL ELSE raw_estrato END"


@query(f"WITH {d.OBS}, m AS (SELECT {d.KEYS}, {_MESSY} AS v FROM obs), c AS (SELECT *, CASE WHEN trim(coalesce(v, '')) IN ('N/A', 'null', 'None', '-1', 'nan', 'NA', 'n/a', 'none') THEN '' ELSE coalesce(v, '') END AS t FROM m) SELECT {d.KEYS}, t AS text_value, CASE WHEN regexp_full_match(trim(t), '[+-]?[0-9]+') THEN trim(t)::BIGINT ELSE 0 END::BIGINT AS number_value FROM c")
def sanitize_value(spark, sf_dir):
    k = F.col("l_orderkey") % 6
    messy = F.when(k == 0, "N/A").when(k == 1, "12.0").when(k == 2, " 12 ").when(k == 3, "null").when(k == 4, F.lit(None).cast("string")).otherwise(F.col("raw_estrato"))
    rows = d.observations(spark, sf_dir).withColumn("v", messy)
    return rows.select(*KEYS, validate.sanitized("v", False).alias("text_value"), validate.sanitized("v", True).alias("number_value"))


@query(f"""WITH {d.LST} SELECT {d.KEYS}, '"' || id || '","' || portal || '","' || tipo || '",' || precio || ',' || area || ',' || habitaciones || ',' || banos || ',' || parqueaderos || ',' || estrato || ',"' || barrio || '","' || url || '"' AS line FROM lst""")
def csv_lines(spark, sf_dir):
    return d.listings(spark, sf_dir).select(*KEYS, csv_line().alias("line"))


@query(f"WITH {d.TBL} SELECT id, portal, tipo, precio, area, habitaciones, banos, parqueaderos, estrato, barrio, url, ciudad, status, strftime(scraped_at, '%Y-%m-%d %H:%M:%S') AS scraped_at FROM tbl")
def export_values_(spark, sf_dir):
    return export_values(d.stored(spark, sf_dir))


query.queries["export_values"] = query.queries.pop("export_values_")
query.oracles["export_values"] = query.oracles.pop("export_values_")


@query(f"WITH {d.RUNS}, {d.DIM} SELECT run, portal, coalesce(min_listings, 0)::INTEGER AS min_listings, CASE WHEN NOT ok THEN portal || ': FAILED — ' || CASE WHEN error = '' THEN 'unknown error' ELSE error END WHEN listings < coalesce(min_listings, 0) THEN portal || ': ' || listings || ' listings (min ' || min_listings || ')' END AS warning FROM runs LEFT JOIN dim USING (portal)")
def min_threshold_join(spark, sf_dir):
    return thresholds(d.runs(spark, sf_dir), d.portals(spark)).select("run", "portal", "min_listings", "warning")


@query(f"WITH {d.RUNS}, {d.DIM} SELECT count(*) FILTER (NOT ok OR listings < coalesce(min_listings, 0)) = 0 AS passed, count(*) FILTER (NOT ok OR listings < coalesce(min_listings, 0)) AS n_warnings FROM runs LEFT JOIN dim USING (portal)")
def validation_verdict(spark, sf_dir):
    n = F.count("warning")
    return thresholds(d.runs(spark, sf_dir), d.portals(spark)).agg((n == 0).alias("passed"), n.alias("n_warnings"))


@query(f"WITH {d.RUNS} SELECT * FROM runs WHERE ok")
def healthy_only(spark, sf_dir):
    return d.runs(spark, sf_dir).filter("ok")


@query(f"WITH {d.RUNS} SELECT count(*) FILTER (ok) AS healthy, count(*) FILTER (ok AND listings > 0) AS successful, count(*) AS runs FROM runs")
def health_counts(spark, sf_dir):
    return d.runs(spark, sf_dir).agg(F.count_if("ok").alias("healthy"), F.count_if(F.col("ok") & (F.col("listings") > 0)).alias("successful"), F.count(F.lit(1)).alias("runs"))


@query(f"WITH {d.RUNS} SELECT sum(listings)::BIGINT AS listings, count(DISTINCT portal) AS portals FROM runs")
def report_summary(spark, sf_dir):
    return d.runs(spark, sf_dir).agg(F.sum("listings").alias("listings"), F.countDistinct("portal").alias("portals"))


_DETAIL = "CASE WHEN ok THEN listings || ' listings    ' || CASE WHEN elapsed < 1 THEN CASE WHEN elapsed = 0 THEN '0.0s' ELSE '0.8s' END WHEN elapsed < 60 THEN floor(elapsed)::INTEGER || 's' ELSE floor(elapsed / 60)::INTEGER || 'm ' || floor(elapsed - 60 * floor(elapsed / 60))::INTEGER || 's' END ELSE '(' || CASE WHEN error = '' THEN 'failed' ELSE error END || ')' END"


@query(f"WITH {d.RUNS} SELECT run, '║ ' || icon || ' ' || portal || repeat(' ', greatest(48 - length(portal) - 2 - length(detail), 0)::BIGINT + 1) || detail || '║' AS line FROM (SELECT *, CASE WHEN ok THEN '✅' ELSE '❌' END AS icon, {_DETAIL} AS detail FROM runs)")
def report_lines(spark, sf_dir):
    detail = F.when(F.col("ok"), F.concat(F.col("listings").cast("string"), F.lit(" listings    "), formats.duration(F.col("elapsed")))).otherwise(F.concat(F.lit("("), F.coalesce(F.nullif("error", F.lit("")), F.lit("failed")), F.lit(")")))
    return d.runs(spark, sf_dir).select("run", formats.result_line(F.col("ok"), F.col("portal"), detail).alias("line"))


QUERIES, ORACLES = query.queries, query.oracles
