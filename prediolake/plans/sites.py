"""The twelve portals as queries: each is paged as a live one would be and scraped, over sites whose cards are parts, twenty to a page."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..schemas import LISTING
from ..sources.scratch import keep
from . import dataset as d
from .portals import collect
from .registry import Registry

query = Registry()
CARDS = 20

#: Pieces of cards, as Spark SQL over part: the number, its type and its price.
_K, _TIPO, _PRICE = "p_partkey", "if(p_partkey % 2 = 0, 'Casa', 'Apto')", "concat('$ 1.', lpad(p_partkey % 1000, 3, '0'), '.000')"


@dataclass(frozen=True)
class Site:
    """card: a part's card, as Spark SQL, '' for none; first, last: what stands before and after a page's cards, {page} and {pages} filled in; between: what parts cards; clamps: whether pages beyond the last show the last; detail: (url, page) of a part's own page, as Spark SQL, null for none."""

    card: str
    first: str = ""
    last: str = ""
    between: str = ""
    clamps: bool = False
    detail: tuple[str, str] | None = None


def _say(*parts: str) -> str:
    """A concatenation in Spark SQL; parts that begin with '=' are expressions."""
    return "concat(" + ", ".join(p[1:] if p.startswith("=") else "'" + p.replace("'", "\\'") + "'" for p in parts) + ")"


def scraped(spark: SparkSession, sf_dir: str, portal: str, site: Site) -> DataFrame:
    """The listings of a portal whose site has all parts, paged by what its answers tell."""
    parts = d.table(spark, sf_dir, "part").withColumn("page", (F.floor(F.col("p_partkey") / CARDS) + 1).cast("int"))
    cards = parts.select("page", "p_partkey", F.expr(site.card).alias("card"))
    pages = cards.groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "card"))), lambda x: F.nullif(x["card"], F.lit(""))), site.between).alias("cards"))
    pages = keep(pages, "site")  # every round of probes reads them
    last = pages.agg(F.max("page").alias("pages"))

    def answers(asked: DataFrame) -> DataFrame:
        known = asked.crossJoin(F.broadcast(last)).withColumn("_shown", F.least("page", "pages") if site.clamps else F.col("page"))  # last is one row
        found = known.join(pages.withColumnRenamed("page", "_shown"), "_shown")
        filled = lambda s: F.replace(F.replace(F.lit(s), F.lit("{pages}"), F.col("pages").cast("string")), F.lit("{page}"), F.col("_shown").cast("string"))
        return found.select("page", F.concat(filled(site.first), "cards", filled(site.last)).alias("html"))

    details = None
    if site.detail:
        url, page = site.detail
        spread = parts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")  # their pages are long and parts are short: a file that one task reads is work for many
        details = spread.select(F.col("p_partkey").alias("pos"), F.expr(url).alias("url"), F.expr(page).alias("html")).filter("html IS NOT NULL")
    return collect(spark, portal, answers, details).select(*LISTING.names)


_BARRIO = d.title_sql("p_name")


def _rows(prefix: str, portal: str, where: str = "", **columns: str) -> str:
    """The expected listings, in DuckDB's SQL over part."""
    given = {
        "id": f"'{prefix}-' || p_partkey", "portal": f"'{portal}'", "tipo": "CASE WHEN p_partkey % 2 = 0 THEN 'casa' ELSE 'apartamento' END", "precio": "(1000000 + (p_partkey % 1000) * 1000)::BIGINT",
        **dict.fromkeys(("area", "habitaciones", "banos", "parqueaderos", "estrato"), "0::INTEGER"), "barrio": _BARRIO, "url": "''", **columns,
    }
    return "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in given.items()) + f" FROM part{' WHERE ' + where if where else ''}"


def _mod(n: int, plus: int = 0) -> str:
    return f"(p_partkey % {n} + {plus})::INTEGER"


def _site(name: str, prefix: str, portal: str, site: Site, where: str = "", **columns: str) -> Callable:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return scraped(spark, sf_dir, portal, site)

    run.__name__ = f"portal_{name}"
    return query(_rows(prefix, portal, where, **columns))(run)


_site(
    "maxibienes", "MXB", "maxibienes",
    Site(_say('<div class="property"><h3>', "=" + _TIPO, "<br>Estrato: ", "=p_partkey % 6 + 1", '</h3><div class="price"><span>', "=" + _PRICE, '</span></div><ul class="amenities"><li>Cod ', "=" + _K, '</li><li><i class="fa fa-compress"></i>', "=p_size", ' m2</li><li><i class="fa fa-bed"></i>', "=p_partkey % 5",
              '</li><li><i class="fa fa-bath"></i>', "=p_partkey % 3", '</li></ul><div class="image"><span class="location">MEDELLIN - ', "=upper(p_name)", '</span><a href="/p/', "=" + _K, '"></a></div></div>'), first="<script>var totalpagina = {pages};</script>"),
    area="p_size", habitaciones=_mod(5), banos=_mod(3), estrato=_mod(6, 1), url="'https://www.maxibienes.com/p/' || p_partkey",
)
_site(
    "metrocasas", "MTC", "metrocasas",
    Site(_say('<div data-property-id="', "=" + _K, '" data-property-url="/x/', "=" + _K, '" data-property-title="', "=" + _TIPO, " en ", "=p_name", '">', "=" + _PRICE, " Área ", "=p_size", " Habitaciones ", "=p_partkey % 5", " Cuartos de baño ", "=p_partkey % 3", "</div>"), last='<a href="/page/2/">2</a><a href="/page/{pages}/">{pages}</a>'),
    area="p_size", habitaciones=_mod(5), banos=_mod(3), url="'https://metrocasas.co/x/' || p_partkey",
)
_site(
    "arrendamientossantafe", "ASF-A", "arrendamientossantafe",
    Site(_say('<div class="property-card"><div class="inner-card"><a href="/d/', "=" + _K, '">x</a></div><span class="id">REF: A', "=" + _K, '</span><p class="tipo-inmueble">Tipo: ', "=" + _TIPO, '</p><div class="precio"><p>', "=" + _PRICE, '</p></div><span class="area">', "=p_size", 'm²</span><span class="alcobas">', "=p_partkey % 5",
              '</span><span class="garaje">', "=p_partkey % 2", '</span><div class="sector"><p class="d-inline">Ubicación: ', "=p_name", "</p></div></div>"), last='<ul><li class="current">{page}</li></ul>', clamps=True,
         detail=(_say("https://www.arrendamientossantafe.com/d/", "=" + _K), f"if(p_partkey % 2 = 0, {_say('<p>Baños: <b>', '=p_partkey % 4', '</b></p><p>Estrato ', '=p_partkey % 6 + 1', '</p>')}, null)")),
    where=f"NOT contains('A' || p_partkey, '{fixed.STALE_CODE}')", id="'ASF-A' || p_partkey", area="p_size", habitaciones=_mod(5), parqueaderos=_mod(2), banos="CASE WHEN p_partkey % 2 = 0 THEN (p_partkey % 4)::INTEGER ELSE 0 END",
    estrato="CASE WHEN p_partkey % 2 = 0 THEN (p_partkey % 6 + 1)::INTEGER ELSE 0 END", url="'https://www.arrendamientossantafe.com/d/' || p_partkey",
)
_site(
    "santillana", "STL", "santillana",
    Site(_say('<div class="property"><div class="title"><h2><a href="/i/', "=" + _K, '">x</a></h2></div><div class="body"><p>Tipo: ', "=" + _TIPO, '</p></div><div class="areaPrecio"><span>', "=" + _PRICE, "</span></div></div>"),
         detail=(_say("https://www.santillana.com.co/i/", "=" + _K), f"if(p_partkey % 3 = 0, null, {_say('<ul class=\"list-li\"><li>Área Construida: ', '=p_size', ' m²</li><li>Alcobas: ', '=p_partkey % 5', '</li><li>Baño: ', '=p_partkey % 4', '</li><li>Garaje: Doble</li><li>Estrato: ', '=p_partkey % 7', '</li><li>Zona / barrio: ', '=p_name', '</li></ul>')})")),
    area="CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE p_size END", habitaciones="CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE (p_partkey % 5)::INTEGER END", banos="CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE (p_partkey % 4)::INTEGER END",
    parqueaderos="CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 2 END", estrato="CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE (p_partkey % 7)::INTEGER END", barrio=f"CASE WHEN p_partkey % 3 = 0 THEN '' ELSE {_BARRIO} END", url="'https://www.santillana.com.co/i/' || p_partkey",
)
_site(
    "arrendamientosmonserrate", "MNS", "arrendamientosmonserrate",
    Site(_say('<li class="product"><a href="/x/', "=" + _K, '">v</a><h2 class="t-Title">', "=p_name", "</h2>", "=" + _PRICE, "</li>"),
         detail=(_say("https://arrendamientosmonserrate.com/x/", "=" + _K), f"if(p_partkey % 4 = 3, null, {_say('<p>Código: ', '=p_partkey', '</p><p>Tipo de inmueble</p><p>', '=' + _TIPO, '</p><p>Área: ', '=p_size', ' m² aprox.</p><p>Alcobas: ', '=p_partkey % 5', '</p><p>Estrato: 0</p>')})")),
    id="CASE WHEN p_partkey % 4 = 3 THEN '' ELSE 'MNS-' || p_partkey END", tipo="CASE WHEN p_partkey % 4 = 3 THEN '' WHEN p_partkey % 2 = 0 THEN 'casa' ELSE 'apartamento' END", area="CASE WHEN p_partkey % 4 = 3 THEN 0 ELSE p_size END",
    habitaciones="CASE WHEN p_partkey % 4 = 3 THEN 0 ELSE (p_partkey % 5)::INTEGER END", url="'https://arrendamientosmonserrate.com/x/' || p_partkey",
)
_site(
    "arrendamientosvillacruz", "AVC", "arrendamientosvillacruz",
    Site(_say('<div class="estate_itm"><p>COD: ', "=" + _K, "</p><p>En Arriendo</p><p>", "=" + _TIPO, "</p><p>", "=" + _PRICE, "</p><p>", "=p_size", " m²</p><p>", "=p_partkey % 5", " Alcobas</p><p>", "=p_partkey % 3", " Baños</p><p>MEDELLIN - ", "=p_name", "</p></div>")),
    area="p_size", habitaciones=_mod(5), banos=_mod(3), url="'https://www.arrendamientosvillacruz.com'",
)
_site(
    "merinohermanos", "MHR", "merinohermanos",
    Site(_say("<p>", "=" + _PRICE, "</p><p>", "=" + _TIPO, "</p><p>", "=" + _K, "</p><p>", "=p_partkey % 5", " Alcobas</p><p>Area ", "=p_size", " m2</p><p>Arriendo - ", "=p_name", "</p>"), first="<p>menu</p>"),
    area="p_size", habitaciones=_mod(5), url="'https://merinohermanos.com.co/?b_type=arriendo'",
)
_site(
    "habitamos", "HBM", "habitamos",
    Site(_say('<div class="card"><h6>', "=" + _TIPO, " - Medellín - ", "=p_name", '</h6><a href="/z/', "=" + _K, '">x</a><p>Code: ', "=" + _K, "</p><p>Rental price: ", "=" + _PRICE, " Sale price: $ 9</p><p>Bedrooms: ", "=p_partkey % 5", " Bathrooms: ", "=p_partkey % 3", " Garage: ", "=p_partkey % 2", "</p></div>")),
    habitaciones=_mod(5), banos=_mod(3), parqueaderos=_mod(2), url="'https://en.habitamos.com.co/z/' || p_partkey",
)
_site(
    "alnago", "ALN", "alnago",
    Site(_say('<article><a href="/es/inmueble/', "=" + _K, '">v</a><p>Zona</p><p>', "=p_name", "</p><p>Precio</p><p>", "=" + _PRICE, "</p><p>Cod:</p><p>", "=" + _K, "</p><p>Bedrooms</p><p>", "=p_partkey % 5", "</p></article>"),
         detail=(_say("https://alnago.com/es/inmueble/", "=" + _K), f"if(p_partkey % 3 = 0, null, {_say('<style>x</style><h1>', '=' + _TIPO, ' en arriendo en Y</h1><p>Área privada</p><p>', '=p_size', ' M2</p><p>Bonito estrato ', '=p_partkey % 6 + 1', '.</p>')})")),
    tipo="CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 2 = 0 THEN 'casa' ELSE 'apartamento' END", area="CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE p_size END", estrato="CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE (p_partkey % 6 + 1)::INTEGER END", habitaciones=_mod(5),
    url="'https://alnago.com/es/inmueble/' || p_partkey",
)
_site(
    "albertoalvarez", "AAL", "albertoalvarez",
    Site(_say('<article><textarea class="field-property">', "=if(p_partkey % 7 = 0, '[bad', " + _say('{"code": "', "=" + _K, '", "propertyType": "Casa Vivienda", "rentValue": ', "=1000000 + (p_partkey % 1000) * 1000", ', "builtArea": ', "=p_size", ', "stratum": "', "=p_partkey % 7", '", "sectorName": "', "=p_name", '"}') + ")", "</textarea></article>")),
    where="p_partkey % 7 <> 0", tipo="'casa'", area="p_size", estrato=_mod(7), url="'https://albertoalvarez.com/inmuebles/detalle/arrendamientos/apartamentos/' || p_partkey || '/' || replace(p_name, ' ', '-') || '-medellin/'",
)
_site(
    "arrendamientosdelnorte", "ADN", "arrendamientosdelnorte",
    Site(_say('{"codigo": "', "=" + _K, '", "tipo": "', "=" + _TIPO, '", "valor": "', "=" + _PRICE, '", "area": "', "=p_size", ' m<sup>2</sup>", "cuartos": "', "=p_partkey % 5", '", "barrio": "', "=p_name", '", "link": "https://a/', "=" + _K, '"}'), first='{"data": [', last="]}", between=", "),
    area="p_size", habitaciones=_mod(5), barrio="p_name", url="'https://a/' || p_partkey",
)
_site(
    "coninsa", "CON", "coninsa",
    Site(_say('{"code": "', "=" + _K, '", "property_type": "', "=if(p_partkey % 3 = 0, 'Bodega', if(p_partkey % 2 = 0, 'Casa finca', 'Apartamento'))", '", "field_lease_value": ', "=1000000 + (p_partkey % 1000) * 1000", ', "field_area": ', "=p_size", '.5, "neighborhood": "', "=p_name", '", "url": "/q/', "=" + _K, '"}'),
         first='{"data": {"searchAPISearch": {"result_count": 9, "documents": [', last="]}}}", between=", "),
    where="p_partkey % 3 <> 0", area="p_size", url="'https://www.coninsa.co/q/' || p_partkey",
)


QUERIES, ORACLES = query.queries, query.oracles
