"""Queries of page enumeration and of field extraction from texts, HTML and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed
from ..functions import lines, normalize
from ..functions.text import number_in, once, strip
from ..schemas import GRAPHQL_ENVELOPE
from ..sources import fetch, files, pagination, scratch
from ..sources.dom import visible_text_udf
from . import dataset as d
from .registry import Registry

query = Registry()


def _part(spark, sf_dir, deal: bool = False):
    """The parts; dealt to all cores where a row's work is long, as files of few bytes make few tasks."""
    part = d.table(spark, sf_dir, "part")
    return part.repartition(max(32, spark.sparkContext.defaultParallelism), "p_partkey") if deal else part


def _say(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])




@query("SELECT page_id, unnest(range(1, least(page_id % 9, 3) + 1))::INTEGER AS page, CASE WHEN page_id % 9 < 1 THEN 1 ELSE (page_id % 9)::INTEGER END AS total FROM pages WHERE page_id % 9 > 0 UNION ALL SELECT page_id, 1, 1 FROM pages WHERE page_id % 9 = 0")
def pages_from_js_var(spark, sf_dir):
    n = F.col("page_id") % 9
    html = F.when(n == 0, "<p>none</p>").otherwise(_say("<script>var  totalpagina = ", n, ";</script>"))
    rows = d.table(spark, sf_dir, "pages").select("page_id", pagination.total_in_script(html).alias("total"))
    return pagination.numbered(rows, F.col("total"), 3).select("page_id", "page", "total")


@query("SELECT page_id, len(regexp_extract_all(html, '<li>')) AS items, greatest(coalesce(list_max(list_transform(regexp_extract_all(html, '/([0-9]+)\"', 1), lambda x: TRY_CAST(x AS INTEGER))), 1), 1)::INTEGER AS pages FROM pages")
def pages_from_links(spark, sf_dir):
    return d.table(spark, sf_dir, "pages").select("page_id", F.regexp_count("html", F.lit("<li>")).cast("bigint").alias("items"), pagination.total_in_links(F.col("html"), '/([0-9]+)"').alias("pages"))


@query("SELECT l_partkey AS source, l_linenumber AS page, (l_orderkey % 4)::INTEGER AS cards FROM (SELECT l_partkey, l_linenumber, max(l_orderkey) AS l_orderkey FROM lineitem GROUP BY ALL) QUALIFY coalesce(l_linenumber < min(CASE WHEN l_orderkey % 4 = 0 THEN l_linenumber END) OVER (PARTITION BY l_partkey), true)")
def paginate_until_empty(spark, sf_dir):
    rows = d.table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_linenumber").agg((F.max("l_orderkey") % 4).cast("int").alias("cards"))
    return pagination.until_empty(rows.select(F.col("l_partkey").alias("source"), F.col("l_linenumber").alias("page"), "cards"), ["source"])


@query("SELECT kind, n_nationkey AS page FROM nation, (VALUES ('apartamentos'), ('casas'), ('apartaestudios')) t(kind)")
def type_page_enumeration(spark, sf_dir):
    return pagination.by_kind(spark, ("apartamentos", "casas", "apartaestudios"), d.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("page"))).select("kind", "page")


@query("SELECT c_nationkey, total, unnest(range(0, total, 20))::INTEGER AS \"offset\" FROM (SELECT c_nationkey, count(*) AS total FROM customer GROUP BY ALL)")
def offset_limit_pages(spark, sf_dir):
    totals = d.table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("total"))
    return pagination.offsets(totals, F.col("total"), 20).select("c_nationkey", "total", "offset")


@query("SELECT n_nationkey, unnest(range(1, least(n_nationkey, 5) + 1))::INTEGER AS page FROM nation")
def page_cap(spark, sf_dir):
    return pagination.numbered(d.table(spark, sf_dir, "nation"), F.col("n_nationkey"), 5).select("n_nationkey", "page")


@query("SELECT l_suppkey AS pos, coalesce(url, '') AS url, coalesce(html, '') AS html FROM (SELECT DISTINCT l_suppkey FROM lineitem) LEFT JOIN pages ON page_id = l_suppkey * 3")
def bulk_fetch_order(spark, sf_dir):
    """Pages by position, fetched in bulk over a transport whose URLs hold their pages; those that aren't found are ''."""
    asked = d.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("pos")).distinct()
    pages = d.table(spark, sf_dir, "pages")
    known = asked.join(pages, F.col("page_id") == F.col("pos") * 3, "left").select("pos", F.col("url").alias("name"), F.coalesce(F.concat(F.lit("data:text/html;base64,"), F.base64(F.encode("html", "UTF-8"))), F.lit("https://gone/")).alias("url"))
    fetched = fetch.bulk_fetch(known, fetch.inline)
    return fetched.select("pos", "html").join(known.select("pos", F.coalesce("name", F.lit("")).alias("url")), "pos").select("pos", "url", "html").orderBy("pos")


@query("SELECT count(*)::INTEGER AS cards, (1 + greatest(0, ceil(log2(count(*) / 10.0))))::INTEGER AS rounds FROM pages")
def fixpoint_growth(spark, sf_dir):
    """A driver's loop by nature: scroll until the count of cards stands; every round shows twice as many of the pages, as far as there are any."""
    pages = d.table(spark, sf_dir, "pages").select("page_id")
    cards, rounds = pagination.fixpoint(lambda k: pages.filter(F.col("page_id") < 10 * 2**k).count())
    return spark.createDataFrame([(cards, rounds)], "cards int, rounds int")


@query(f"WITH {d.LST} SELECT id, portal, tipo, precio, 0::INTEGER AS area, habitaciones, banos, 0::INTEGER AS parqueaderos, estrato, CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE barrio END AS barrio, url FROM lst WHERE l_orderkey % 4 = 0")
def json_lines_load(spark, sf_dir):
    """Listings out of files of JSON lines, some fields of which are missing or null."""
    rows = d.listings(spark, sf_dir).filter(F.col("l_orderkey") % 4 == 0)
    path = scratch.folder(spark, "json")
    rows.select("id", "portal", "tipo", "precio", "habitaciones", "banos", "estrato", F.when(F.col("l_linenumber") % 2 == 1, F.col("barrio")).alias("barrio"), "url", F.lit(None).cast("int").alias("parqueaderos")).write.json(path)
    return files.load_json(spark, path, lines=True)


@query("SELECT event_id, (props ->> 'k')::INTEGER AS k, CASE WHEN event_id % 5 = 0 THEN 'ARRAY' ELSE 'OBJECT' END AS kind FROM events WHERE event_id % 5 IN (0, 1, 2)")
def json_load(spark, sf_dir):
    m = F.col("event_id") % 5
    body = F.when(m == 0, F.concat(F.lit("["), F.col("props"), F.lit("]"))).when(m == 3, "oops").when(m == 4, "12").otherwise(F.col("props"))
    parsed = d.table(spark, sf_dir, "events").withColumn("body", body).withColumn("v", F.try_parse_json("body"))
    kind = F.schema_of_variant("v")
    kept = parsed.withColumn("kind", F.when(kind.startswith("OBJECT"), "OBJECT").when(kind.startswith("ARRAY"), "ARRAY")).filter("kind IS NOT NULL")
    return kept.select("event_id", F.coalesce(F.try_variant_get("v", "$.k", "int"), F.try_variant_get("v", "$[0].k", "int")).alias("k"), "kind")




@query(f"SELECT p_partkey, {d.price_sql('price')} AS precio, (p_size * 3)::INTEGER AS area, (p_partkey % 6)::INTEGER AS habitaciones, (p_partkey % 4)::INTEGER AS banos FROM (SELECT *, '$ ' || p_partkey || '.000' AS price FROM part)")
def mtc_text_fields(spark, sf_dir):
    k = F.col("p_partkey")
    card = _say("Precio $ ", k, ".000 Área  ", F.col("p_size") * 3, " m2 Habitaciones ", k % 6, " Cuartos de baño ", k % 4)
    price = normalize.price(F.regexp_extract(card, r"\$\s*([\d.,]+)", 0))
    fields = [number_in(card, p).alias(n) for n, p in (("area", r"Área\s+(\d+)"), ("habitaciones", r"Habitaciones\s+(\d+)"), ("banos", r"Cuartos\s+de\s+baño\s+(\d+)"))]
    return _part(spark, sf_dir).select("p_partkey", price.alias("precio"), *fields)


def title_split_of(title):
    """(type, barrio) of 'X en Y', in any case; without ' en ', of the first word and the rest."""
    s = strip(title)
    at = F.instr(F.lower(s), " en ")
    head = F.when(at > 0, F.substring(s, F.lit(1), at - 1)).otherwise(F.regexp_extract(s, r"^(\S*)", 1))
    rest = F.when(at > 0, F.substring(s, at + 4, F.length(s))).otherwise(strip(F.regexp_replace(s, r"^\S*", "")))
    return normalize.tipo(head), normalize.barrio(rest)


@query(f"SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'casa' WHEN 1 THEN 'apartamento' ELSE 'bodega' END AS tipo, {d.title_sql('p_name')} AS barrio FROM part")
def title_split(spark, sf_dir):
    m = F.col("p_partkey") % 3
    tipo, barrio = title_split_of(F.when(m == 0, _say("Casa EN ", F.col("p_name"))).when(m == 1, _say("Apto en MEDELLIN - ", F.col("p_name"))).otherwise(_say("Bodega ", F.col("p_name"))))
    return _part(spark, sf_dir).select("p_partkey", tipo.alias("tipo"), barrio.alias("barrio"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE (p_partkey % 7)::INTEGER END AS banos, CASE WHEN p_partkey % 9 = 8 THEN 0 ELSE (p_partkey % 9)::INTEGER END AS estrato FROM part")
def asf_detail_regex(spark, sf_dir):
    k = F.col("p_partkey")
    page = _say("Interior ESTRATO : ", k % 9, " <b>", F.when(k % 5 == 0, "sin datos").when(k % 2 == 0, _say("BAÑOS: ", k % 7)).otherwise(_say("bano ", k % 7)), "</b>")
    return _part(spark, sf_dir).select("p_partkey", number_in(page, r"(?iu)ba[ñn]os?\s*:?\s*(\d+)").alias("banos"), normalize.estrato_number(number_in(page, r"(?iu)estrato\s*:?\s*(\d+)")).alias("estrato"))


@query("SELECT page_id, coalesce(list_extract(string_split(rtrim(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/]*', ''), '/'), '/'), -1), '') AS code FROM pages")
def code_from_url(spark, sf_dir):
    return d.table(spark, sf_dir, "pages").select("page_id", normalize.code_from_url(F.col("url")).alias("code"))


@query(f"SELECT p_partkey, p_size AS area, CASE WHEN p_partkey % 2 = 0 THEN 2 ELSE 1 END AS banos, {d.garaje_sql('g')} AS parqueaderos, {d.estrato_sql('e')} AS estrato, {d.title_sql('p_name')} AS barrio FROM (SELECT *, {d.picked(d.RAW_GARAJE, 'p_partkey')} AS g, {d.picked(d.RAW_ESTRATO, 'p_partkey')} AS e FROM part)")
def label_colon_value(spark, sf_dir):
    k = F.col("p_partkey")
    items = F.array(_say("Área Construida: ", F.col("p_size"), " m"), F.lit("Baños: 1"), F.when(k % 2 == 0, "Baño: 2").otherwise("Otro: 5"), _say("Garaje: ", d._pick(d.RAW_GARAJE, k)), _say("Estrato: ", d._pick(d.RAW_ESTRATO, k)), _say("Zona / barrio: ", F.col("p_name")))
    value = lambda *labels: lines.labelled_item(items, *labels)
    from ..functions.text import digits, whole

    return _part(spark, sf_dir).select(
        "p_partkey", whole(digits(value("Área Construida"))).alias("area"), whole(digits(value("Baños", "Baño"))).alias("banos"), normalize.garaje(value("Garaje")).alias("parqueaderos"),
        normalize.estrato(value("Estrato")).alias("estrato"), normalize.barrio(value("Zona / barrio")).alias("barrio"),
    )


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_brand ELSE p_type END AS tipo, p_size || ' mts' AS area, CASE WHEN p_partkey % 2 = 0 THEN 'c' || p_partkey ELSE '' END AS codigo FROM part")
def label_next_line(spark, sf_dir):
    k = F.col("p_partkey")
    first = F.when(k % 3 == 0, _say("Tipo de inmueble: ", F.col("p_name"))).when(k % 3 == 1, _say("TIPO DE INMUEBLE\n\n", F.col("p_brand"))).otherwise(_say("tipo de inmueble ", F.col("p_type")))
    page = _say(first, "\nÁrea:\nÁREA : ", F.col("p_size"), " mts\nÁrea: 1\n", F.when(k % 2 == 0, _say("Código\nc", k)).otherwise(F.lit("Codigo:")))
    return _part(spark, sf_dir, True).select("p_partkey", F.inline(once(lines.lines(page), lines.detail_labels))).select("p_partkey", "tipo", "area", "codigo")


@query(f"SELECT p_partkey, p_partkey::VARCHAR AS codigo, CASE WHEN p_partkey % 2 = 0 THEN 'casa' ELSE 'apartamento' END AS tipo, (p_partkey * 1000)::BIGINT AS precio, p_size AS area, (p_partkey % 5)::INTEGER AS habitaciones, (p_partkey % 3)::INTEGER AS banos, CASE WHEN p_partkey % 4 = 0 THEN 2 ELSE 0 END AS parqueaderos, {d.title_sql('p_name')} AS barrio FROM part WHERE p_partkey % 10 <> 0")
def card_line_state(spark, sf_dir):
    k = F.col("p_partkey")
    area = F.when(k % 2 == 0, _say(F.col("p_size"), "\nm²")).otherwise(_say("1 m²\n", F.col("p_size"), " m²"))
    page = _say(F.when(k % 10 == 0, "sin").otherwise(_say("COD: ", k, " COD: 7")), "\nEn Arriendo\n", F.when(k % 2 == 0, "House").otherwise("Apto-x"), "\n$ ", k, ".000\n$ 5\n", area, "\n", k % 5, " Alcobas\n", k % 3, " Baños\n", F.when(k % 4 == 0, "2 parq.").otherwise("-"), "\nMEDELLIN - ", F.col("p_name"), "\nA - B")
    rows = _part(spark, sf_dir, True).select("p_partkey", F.inline(once(lines.lines(page), lines.stateful_card)))
    return rows.filter("codigo <> ''")


@query("SELECT p_partkey, card::INTEGER AS card, CASE card WHEN 0 THEN 'menu' ELSE '$ ' || card || '|' || p_name END AS text FROM part, range(0, 3) t(card) WHERE card <= 1 + p_partkey % 2 AND NOT (card = 0 AND p_partkey % 5 = 0)")
def card_sessionize(spark, sf_dir):
    k = F.col("p_partkey")
    page = _say(F.when(k % 5 == 0, "").otherwise("menu\n"), "$ 1\n", F.col("p_name"), F.when(k % 2 == 1, _say("\n\n$ 2\n ", F.col("p_name"))).otherwise(""))
    cards = lines.split_cards(lines.lines(page), lines.starts_with_price)
    rows = _part(spark, sf_dir).select("p_partkey", F.posexplode(cards).alias("card", "rows"))
    at = F.when(k % 5 == 0, F.col("card") + 1).otherwise(F.col("card"))
    return rows.select("p_partkey", at.alias("card"), F.array_join("rows", "|").alias("text"))


@query("SELECT p_partkey, (p_partkey * 1000)::BIGINT AS precio, (p_partkey % 4)::INTEGER AS habitaciones, p_size AS area, p_name AS barrio, CASE WHEN p_partkey % 3 = 0 THEN p_partkey::VARCHAR ELSE '' END AS codigo, 'Casa' AS tipo FROM part WHERE p_partkey % 7 <> 0")
def card_rule_chain(spark, sf_dir):
    k = F.col("p_partkey")
    page = _say(F.when(k % 7 == 0, "gratis").otherwise(_say("$ ", k, ".000")), "\nCasa\n", F.when(k % 3 == 0, k.cast("string")).otherwise("x y"), "\nArriendo - ", F.col("p_name"), "\n", k % 4, " Alcobas\nunos baños\nArea de ", F.col("p_size"), " m2\nOtra")
    rows = _part(spark, sf_dir, True).select("p_partkey", F.explode(once(lines.lines(page), lines.ruled_card)).alias("c"))
    kept = rows.filter((F.col("c.precio") > 0) & (lines.structural(F.col("c")) >= 2))
    return kept.select("p_partkey", "c.precio", "c.habitaciones", "c.area", "c.barrio", "c.codigo", "c.tipo")


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_partkey::VARCHAR END AS codigo, (p_size * 100000)::BIGINT AS precio, (p_partkey % 5)::INTEGER AS habitaciones, (p_partkey % 4)::INTEGER AS banos, CASE WHEN p_partkey % 2 = 0 THEN (p_partkey % 3)::INTEGER ELSE 0 END AS parqueaderos FROM part")
def label_proximity(spark, sf_dir):
    k = F.col("p_partkey")
    card = _say("Casa - Medellin - x ", F.when(k % 3 == 0, "Código: x1").otherwise(_say("CODE: ", k)), " Rental price: $ ", F.col("p_size"), "00.000 Sale price: $ 9 Alcobas: ", k % 5, ", Baños: ", k % 4, ". ", F.when(k % 2 == 0, _say("Parqueadero: ", k % 3)).otherwise("nada"))
    features = [lines.near_label(card, labels).alias(field) for field, labels in fixed.FEATURES.items()]
    return _part(spark, sf_dir).select("p_partkey", lines.code_near_label(card).alias("codigo"), lines.rent_near_label(card).alias("precio"), *features)


@query("SELECT p_partkey, p_name AS zona, '$ ' || p_size AS precio, CASE WHEN p_partkey % 2 = 0 THEN p_partkey::VARCHAR ELSE 'a' || p_partkey END AS codigo FROM part")
def alternating_pairs(spark, sf_dir):
    k = F.col("p_partkey")
    card = _say("Zona\n", F.col("p_name"), "\nZona\nno\nPrecio\n$ ", F.col("p_size"), "\n", F.when(k % 2 == 0, _say("Cod: ", k)).otherwise(_say("COD\na", k, "\nCod\nb")))
    rows = _part(spark, sf_dir, True).select("p_partkey", F.explode(once(lines.lines(card), lines.pairs)).alias("found"))
    return rows.select("p_partkey", *(F.try_element_at("found", F.lit(f)).alias(f) for f in ("zona", "precio", "codigo")))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'apartamento' WHEN 1 THEN 'casa' ELSE 'villa' END AS tipo, CASE WHEN p_partkey % 2 = 0 THEN p_size WHEN p_partkey % 5 = 0 THEN 0 ELSE 70 END AS area, CASE WHEN p_partkey % 9 = 8 THEN 0 ELSE (p_partkey % 9)::INTEGER END AS estrato FROM part")
def detail_priority_coalesce(spark, sf_dir):
    k = F.col("p_partkey")
    kind = F.when(k % 3 == 0, "Apartment").when(k % 3 == 1, "DUPLEX").otherwise("Villa")
    page = _say("Inicio\n", kind, " en arriendo en Laureles\nCasa en venta\n", F.when(k % 5 == 0, "x\ny").otherwise("Área terreno\n70 M2"), "\n", F.when(k % 2 == 0, _say("Área privada\n", F.col("p_size"), "M2")).otherwise("-"), "\nBonito, ESTRATO  ", k % 9, ". estrato 3")
    return _part(spark, sf_dir, True).select("p_partkey", F.inline(once(lines.lines(page), lines.detail_by_priority)))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_size WHEN 1 THEN p_size ELSE 0 END::INTEGER AS m2 FROM part")
def extract_m2(spark, sf_dir):
    m = F.col("p_partkey") % 3
    raw = F.when(m == 0, _say(F.col("p_size"), " M2")).when(m == 1, _say(" ~", F.col("p_size"), "m2 3")).otherwise(_say("M ", F.col("p_size")))
    return _part(spark, sf_dir).select("p_partkey", normalize.square_metres(raw).alias("m2"))


@query(f"SELECT p_partkey, 'AAL-' || p_partkey AS id, 'casa' AS tipo, floor(p_retailprice)::BIGINT * 1000 AS precio, p_size AS area, CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE (p_partkey % 3)::INTEGER END AS banos, {d.estrato_sql('e')} AS estrato, {d.title_sql('p_name')} AS barrio FROM (SELECT *, {d.picked(d.RAW_ESTRATO, 'p_partkey')} AS e FROM part) WHERE p_partkey % 5 NOT IN (0, 1)")
def json_card_extract(spark, sf_dir):
    k = F.col("p_partkey")
    good = _say('{"code": ', k, ', "propertyType": "Casa Vivienda", "rentValue": ', F.floor("p_retailprice") * 1000, ', "builtArea": ', F.col("p_size"), '.5, "householdFeatures": ', F.when(k % 4 == 0, "null").otherwise(_say('{"baths": ', k % 3, "}")), ', "stratum": "', d._pick(d.RAW_ESTRATO, k), '", "sectorName": "', F.col("p_name"), '"}')
    rows = _part(spark, sf_dir).withColumn("card", F.when(k % 5 == 0, "[1]").when(k % 5 == 1, "{bad").otherwise(good))
    return json_cards(rows, "card", "p_partkey").select("p_partkey", "id", "tipo", "precio", "area", "banos", "estrato", "barrio")


def json_cards(rows, card: str, *keep: str):
    """Listings of cards that are JSON objects; invalid text, arrays and scalars go."""
    v = rows.withColumn("_v", F.try_parse_json(card)).filter(F.schema_of_variant("_v").startswith("OBJECT"))
    get = lambda path, kind="string": F.try_variant_get("_v", f"$.{path}", kind)
    number = lambda path: F.coalesce(F.floor(get(path, "double")).cast("int"), F.lit(0))
    kind = strip(F.coalesce(get("propertyType"), F.lit("")))
    from ..functions.text import look_up

    return v.select(
        *keep, normalize.compose_id("AAL", strip(F.coalesce(get("code"), F.lit("")))).alias("id"), normalize.tipo(look_up(fixed.RENAMED_LOWER, F.lower(kind), kind)).alias("tipo"),
        F.coalesce(F.floor(get("rentValue", "double")).cast("bigint"), normalize.price(get("rentValue"))).alias("precio"), number("builtArea").alias("area"), number("numberOfRooms").alias("habitaciones"),
        number("householdFeatures.baths").alias("banos"), number("householdFeatures.AASimpleparking").alias("parqueaderos"), normalize.estrato(get("stratum")).alias("estrato"), normalize.barrio(get("sectorName")).alias("barrio"),
        normalize.slug(get("sectorName")).alias("slug"),
    )


def rest_items(rows, *keep: str):
    """Listings of REST items (codigo, tipo, valor, area, cuartos, barrio, link)."""
    from ..functions.text import text, whole

    return rows.select(
        *keep, normalize.compose_id("ADN", strip(text("codigo"))).alias("id"), normalize.tipo(F.col("tipo")).alias("tipo"), normalize.price(F.col("valor")).alias("precio"), normalize.area_before_m(F.col("area")).alias("area"),
        whole(F.regexp_extract(text("cuartos"), "^([0-9]+)", 1)).alias("habitaciones"), strip(text("barrio")).alias("barrio"), strip(text("link")).alias("url"),
    )


@query("SELECT p_partkey, 'ADN-' || p_partkey AS id, 'apartamento' AS tipo, (p_partkey * 1000)::BIGINT AS precio, CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE p_size END AS area, (p_partkey % 5)::INTEGER AS habitaciones, p_name AS barrio, 'https://a.co/' || p_partkey AS url FROM part")
def adn_build_item(spark, sf_dir):
    k = F.col("p_partkey")
    rows = _part(spark, sf_dir).select(
        k, k.cast("string").alias("codigo"), F.lit(" Apartamento").alias("tipo"), _say("$", k, ".000").alias("valor"), F.when(k % 4 == 0, "").otherwise(_say(F.col("p_size"), " m<sup>2</sup> aprox.")).alias("area"),
        (k % 5).cast("string").alias("cuartos"), _say(" ", F.col("p_name"), " ").alias("barrio"), _say("https://a.co/", k).alias("link"),
    )
    return rest_items(rows, "p_partkey")


def documents_of(envelopes, column: str, *keep: str):
    """Listings of a GraphQL answer's documents of residential types; missing numbers are 0."""
    doc = envelopes.withColumn("_e", F.from_json(column, GRAPHQL_ENVELOPE)).select(*keep, F.explode("_e.data.searchAPISearch.documents").alias("x")).select(*keep, "x.*").filter(F.col("property_type").isin(*fixed.RESIDENTIAL))
    number = lambda c, kind="int": F.coalesce(F.floor(c).cast(kind), F.lit(0).cast(kind))
    from ..functions.text import look_up, text

    return doc.select(
        *keep, normalize.compose_id("CON", F.col("code"), True).alias("id"), F.coalesce(look_up(fixed.RENAMED, F.col("property_type")), normalize.tipo(F.col("property_type"))).alias("tipo"),
        number("field_lease_value", "bigint").alias("precio"), number("field_area").alias("area"), number("field_bedrooms").alias("habitaciones"), number("field_bathrooms").alias("banos"), number("field_garages").alias("parqueaderos"),
        number("field_stratum").alias("estrato"), normalize.barrio(F.col("neighborhood")).alias("barrio"), F.when(text("url") == "", "").otherwise(F.concat(F.lit("https://www.coninsa.co"), F.col("url"))).alias("url"),
    )


@query(f"SELECT p_partkey, 'CON-' || p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN 'casa' ELSE 'apartamento' END AS tipo, floor(p_retailprice)::BIGINT AS precio, p_size AS area, 0 AS habitaciones, CASE WHEN p_partkey % 2 = 0 THEN 8 ELSE 0 END AS estrato, {d.title_sql('p_name')} AS barrio FROM part WHERE p_partkey % 3 <> 2")
def con_map_listing(spark, sf_dir):
    k = F.col("p_partkey")
    kind = F.when(k % 3 == 0, "Casa finca").when(k % 3 == 1, "Apartamento").otherwise("Bodega")
    answer = _say('{"data": {"searchAPISearch": {"result_count": 1, "documents": [{"code": "', k, '", "property_type": "', kind, '", "field_lease_value": ', F.col("p_retailprice"), ', "field_area": ', F.col("p_size"), ".7", F.when(k % 2 == 0, ', "field_stratum": 8').otherwise(""), ', "neighborhood": "', F.col("p_name"), '"}]}}}')
    return documents_of(_part(spark, sf_dir).withColumn("answer", answer), "answer", "p_partkey").select("p_partkey", "id", "tipo", "precio", "area", "habitaciones", "estrato", "barrio")


def _html_sql(x: str) -> str:
    for tag in fixed.LINE_TAGS:
        x = f"replace({x}, '{tag}', '{tag}' || chr(10))"
    x = f"regexp_replace(regexp_replace({x}, '<[^>]+>', ' ', 'g'), '[ \\t]+', ' ', 'g')"
    for name, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        x = f"replace({x}, '{name}', '{sign}')"
    return x


@query(f"SELECT page_id, {_html_sql('html')} AS text FROM pages")
def html_to_text(spark, sf_dir):
    return d.table(spark, sf_dir, "pages").select("page_id", lines.html_lines(F.col("html")).alias("text"))


@query()
def html_to_text_parser(spark, sf_dir):
    return d.table(spark, sf_dir, "pages").select("page_id", visible_text_udf("html").alias("text"))


QUERIES, ORACLES = query.queries, query.oracles
