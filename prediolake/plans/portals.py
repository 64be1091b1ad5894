"""The twelve portals: from saved pages to listings with warnings.

A portal's pages are a DataFrame (pos, page, html) and, where it has a second phase, its detail pages (pos, url,
html). Cards that need an element tree are cut by an Arrow UDF into raw texts; every normalizer, merge and rule is a
native expression. No portal module touches the network: see sources.fetch for what fills the pages.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .. import fixed
from ..functions import lines, normalize, validate
from ..functions.text import digits, number_in, once, strip, text, whole
from ..operators import dedupe, merge
from ..schemas import LISTING, MEASURES
from ..sources import discovery, dom, pagination
from .extraction import documents_of, json_cards, rest_items, title_split_of

_CARD = "pos long, card int, c map<string,string>"
#: Pages whose cards a Python task holds at a time.
PAGES = 32


def _seq(card: Column) -> Column:
    """A card's place among all of a portal: its page, then its place there; no page has 2^32 cards."""
    return F.shiftleft(F.col("pos").cast("long"), 32) + card


def _cards(pages: DataFrame, cut: Callable[[dom.Element], list[dict[str, str]]]) -> DataFrame:
    """(seq, c): the raw fields of each card of each page, in order."""
    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), PAGES):
                part = b.iloc[at : at + PAGES]
                rows = [(pos, card, c) for pos, html in zip(part["pos"], part["html"], strict=True) if html for card, c in enumerate(cut(dom.parse(html)))]
                yield pd.DataFrame(rows, columns=["pos", "card", "c"])

    rows = pages.select(F.col("pos").cast("long").alias("pos"), "html").mapInPandas(found, _CARD)
    return rows.select(_seq(F.col("card")).alias("seq"), "c")


def _said(field: str) -> Column:
    return text(F.col("c")[field])


def _count(field: str) -> Column:
    return whole(digits(_said(field)))


def shaped(rows: DataFrame, portal: str, *keep: str) -> DataFrame:
    """Rows as listings: the columns they lack are 0 or ''."""
    given = {"portal": F.lit(portal)} | {c: F.col(c) for c in rows.columns if c != "portal"}
    return rows.select(*keep, *((given.get(f.name, F.lit(0 if f.name in MEASURES else ""))).cast(f.dataType).alias(f.name) for f in LISTING))


def _own(e: dom.Element | None, strip_each: bool = True) -> str:
    return e.text(strip=strip_each) if e is not None else ""


def maxibienes(pages: DataFrame, details: DataFrame | None = None) -> DataFrame:
    def cut(root: dom.Element) -> list[dict[str, str]]:
        out = []
        for card in root.all(cls="property"):
            heading, items = card.one("h3"), [li for a in card.all(cls="amenities") for li in a.all("li")]
            c = {"code": items[0].text(strip=True) if items else "", "price": _own(card.one((None, "price"), "span")), "place": _own(card.one((None, "image"), (None, "location")))}
            if heading:
                before: list[str] = []
                for child in heading.children:
                    if isinstance(child, dom.Element) and child.tag == "br":
                        break
                    before.append(child.strip() if isinstance(child, str) else child.text(strip=True))
                c |= {"tipo": "".join(before), "heading": heading.text(strip=True)}
            for li in items:
                icon = li.one("i")
                field = next((fixed.ICONS[k] for k in icon.classes if k in fixed.ICONS), None) if icon else None
                if field:
                    c[field] = li.text(strip=True)
            link = card.one((None, "image"), "a", has="href")
            out.append(c | {"url": link.attributes["href"] if link else ""})
        return out

    rows = _cards(pages, cut).select(
        "seq", normalize.compose_id("MXB", digits(_said("code"))).alias("id"), normalize.tipo(_said("tipo")).alias("tipo"), normalize.price(_said("price")).alias("precio"),
        whole(digits(F.split_part(_said("area"), F.lit("m"), F.lit(1)))).alias("area"), *(_count(f).alias(f) for f in ("habitaciones", "banos", "parqueaderos")),
        normalize.estrato_number(number_in(_said("heading"), r"(?iu)estrato[:\s]*(\d+)")).alias("estrato"), normalize.barrio(_said("place")).alias("barrio"), normalize.url(_said("url"), "https://www.maxibienes.com").alias("url"),
    )
    return shaped(rows, "maxibienes", "seq")


def metrocasas(pages: DataFrame, details: DataFrame | None = None) -> DataFrame:
    def cut(root: dom.Element) -> list[dict[str, str]]:
        return [
            {"code": card.attributes["data-property-id"], "url": card.attributes.get("data-property-url", ""), "title": card.attributes.get("data-property-title") or _own(card.one("h3")), "text": card.text(" ")}
            for card in root.all(has="data-property-id")
        ]

    cards = _cards(pages, cut)
    tipo, barrio = title_split_of(_said("title"))
    number = lambda p: number_in(_said("text"), p)
    rows = cards.select(
        "seq", normalize.compose_id("MTC", _said("code")).alias("id"), tipo.alias("tipo"), barrio.alias("barrio"), normalize.price(F.regexp_extract(_said("text"), r"\$\s*([\d.,]+)", 0)).alias("precio"), number(r"Área\s+(\d+)").alias("area"),
        number(r"Habitaciones\s+(\d+)").alias("habitaciones"), number(r"Cuartos\s+de\s+baño\s+(\d+)").alias("banos"), normalize.url(_said("url"), "https://metrocasas.co").alias("url"),
    )
    return shaped(rows, "metrocasas", "seq")


def santafe(pages: DataFrame, details: DataFrame | None = None) -> DataFrame:
    def cut(root: dom.Element) -> list[dict[str, str]]:
        out = []
        for card in root.all(cls="property-card"):
            link = card.one((None, "inner-card"), "a", has="href")
            out.append(
                {
                    "code": _own(card.one(("span", "id"))), "tipo": _own(card.one(("p", "tipo-inmueble"))), "price": _own(card.one(("div", "precio"), "p")), "area": _own(card.one(("span", "area"))),
                    "rooms": _own(card.one(("span", "alcobas"))), "garage": _own(card.one(("span", "garaje"))), "place": _own(card.one((None, "sector"), ("p", "d-inline"))), "url": link.attributes["href"] if link else "",
                }
            )
        return out

    after_colon = lambda f: strip(F.regexp_replace(_said(f), "^[^:]*:", ""))
    code = F.when(_said("code").contains(":"), strip(F.substring_index(_said("code"), ":", -1))).otherwise("")
    rows = _cards(pages, cut).select(
        "seq", normalize.compose_id("ASF", code).alias("id"), normalize.tipo(after_colon("tipo")).alias("tipo"), normalize.price(_said("price")).alias("precio"), whole(digits(F.split_part(_said("area"), F.lit("m"), F.lit(1)))).alias("area"),
        _count("rooms").alias("habitaciones"), _count("garage").alias("parqueaderos"), normalize.barrio(after_colon("place")).alias("barrio"), normalize.url(_said("url"), "https://www.arrendamientossantafe.com").alias("url"),
    )
    cards = shaped(rows, "arrendamientossantafe", "seq").filter(~F.col("id").contains(fixed.STALE_CODE))
    if details is None:
        return cards
    page = F.regexp_replace(text("html"), "<[^>]+>", " ")
    found = details.select("pos", "url", number_in(page, r"(?iu)ba[ñn]os?\s*:?\s*(\d+)").alias("banos"), normalize.estrato_number(number_in(page, r"(?iu)estrato\s*:?\s*(\d+)")).alias("estrato"))
    return merge.fill(cards, found, ("banos", "estrato"))


def santillana(pages: DataFrame, details: DataFrame | None = None) -> DataFrame:
    def cut(root: dom.Element) -> list[dict[str, str]]:
        out = []
        for card in root.all(cls="property"):
            link = card.one(("div", "title"), "h2", "a", has="href")
            kinds = [t for b in card.all(cls="body") for p in b.all("p") if (t := p.text(strip=True)).startswith("Tipo:")]
            out.append({"url": link.attributes["href"] if link else "", "tipo": kinds[0][5:] if kinds else "", "price": _own(card.one((None, "areaPrecio"), "span"))})
        return out

    url = normalize.url(_said("url"), "https://www.santillana.com.co")
    rows = _cards(pages, cut).select("seq", F.when(url == "", "").otherwise(normalize.compose_id("STL", normalize.code_from_url(url), True)).alias("id"), normalize.tipo(_said("tipo")).alias("tipo"), normalize.price(_said("price")).alias("precio"), url.alias("url"))
    cards = shaped(rows, "santillana", "seq")
    if details is None:
        return cards

    @F.pandas_udf(ArrayType(StringType()))
    def items(html: pd.Series) -> pd.Series:
        return html.map(lambda x: [li.text(strip=True) for ul in dom.parse(x).all("ul", "list-li") for li in ul.all("li")])

    value = lambda *labels: lines.labelled_item(F.col("i"), *labels)
    found = details.filter(text("html") != "").withColumn("i", items("html")).select(
        "pos", "url", whole(digits(value("Área Construida"))).alias("area"), whole(digits(value("Alcobas"))).alias("habitaciones"), whole(digits(value("Baños", "Baño"))).alias("banos"), normalize.garaje(value("Garaje")).alias("parqueaderos"),
        normalize.estrato(value("Estrato")).alias("estrato"), normalize.barrio(value("Zona / barrio")).alias("barrio"),
    )
    return merge.overwrite(cards, found, ("area", "habitaciones", "banos", "parqueaderos", "estrato", "barrio"))


def monserrate(pages: DataFrame, details: DataFrame | None = None) -> DataFrame:
    base = "https://arrendamientosmonserrate.com/"

    def cut(root: dom.Element) -> list[dict[str, str]]:
        items = root.all("li", test=lambda e: any("product" in c for c in e.classes)) or [li for li in root.all("li") if li.one("a", has="href") and re.search(r"\$\s*[\d.]+", li.text())]
        out = []
        for li in items:
            link, price = li.one("a", has="href"), re.search(r"\$\s*([\d.]+)", li.text())
            heads = [h for h in li.descend() if h.tag in ("h2", "h3") and any("title" in c.lower() for c in h.classes)]
            if link and price:
                out.append({"url": urljoin(base, link.attributes["href"]), "price": price.group(0), "title": _own(heads[0] if heads else None)})
        return out

    rows = _cards(pages, cut).select("seq", normalize.price(_said("price")).alias("precio"), normalize.barrio(_said("title")).alias("barrio"), _said("url").alias("url")).filter("precio > 0")
    cards = shaped(rows, "arrendamientosmonserrate", "seq")
    if details is None:
        return cards
    f = once(lines.lines(lines.html_lines(F.col("html"))), lines.detail_labels)
    area = F.regexp_replace(F.lower(F.col("f.area")), "m²|m2| mt|aprox\\.|aproximadamente", "")
    found = details.select("*", F.explode(f).alias("f")).select(
        "pos", "url", normalize.compose_id("MNS", F.coalesce(F.nullif("f.codigo", F.lit("")), F.regexp_extract("html", r"[^\d](\d{4,5})(?:-\d+)?\.jpe?g", 1))).alias("id"), normalize.tipo(F.col("f.tipo")).alias("tipo"), whole(digits(area)).alias("area"),
        whole(digits(F.col("f.habitaciones"))).alias("habitaciones"), whole(digits(F.col("f.banos"))).alias("banos"), normalize.garaje(F.col("f.parqueaderos")).alias("parqueaderos"), normalize.estrato(F.col("f.estrato")).alias("estrato"), normalize.barrio(F.col("f.barrio")).alias("barrio"),
    )
    return merge.fill_first(cards, found, ("id", "tipo", "area", "habitaciones", "banos", "parqueaderos", "estrato", "barrio"), ["seq"])


def villacruz(pages: DataFrame, details: DataFrame | None = None) -> DataFrame:
    def cut(root: dom.Element) -> list[dict[str, str]]:
        cards = root.all(test=lambda e: "estate_itm" in e.attributes.get("class", "") and "estate_itm--" not in e.attributes.get("class", ""))
        return [{"text": c.text("\n")} for c in cards]

    c = _cards(pages, cut).select("seq", F.inline(once(lines.lines(_said("text")), lines.stateful_card))).filter("codigo <> ''")
    rows = c.select("seq", normalize.compose_id("AVC", F.col("codigo")).alias("id"), "*", F.lit("https://www.arrendamientosvillacruz.com").alias("url")).drop("codigo")
    return dedupe.first_wins(shaped(rows, "arrendamientosvillacruz", "seq"), ["id"], ["seq"]).select("seq", *LISTING.names)


def merinohermanos(pages: DataFrame, details: DataFrame | None = None) -> DataFrame:
    cards = once(lines.lines(lines.html_lines(F.col("html"))), lambda rows: lines.split_cards(rows, lines.starts_with_price))
    found = pages.select("pos", F.explode(cards).alias("cards")).select("pos", F.posexplode("cards").alias("card", "rows")).select(_seq(F.col("card")).alias("seq"), F.explode(once(F.col("rows"), lines.ruled_card)).alias("c"))
    kept = found.filter((F.col("c.precio") > 0) & (lines.structural(F.col("c")) >= 2))
    rows = kept.select("seq", normalize.compose_id("MHR", F.col("c.codigo")).alias("id"), normalize.tipo(F.col("c.tipo")).alias("tipo"), normalize.barrio(F.col("c.barrio")).alias("barrio"), *(F.col(f"c.{f}") for f in ("precio", "area", "habitaciones", "banos")), F.lit("https://merinohermanos.com.co/?b_type=arriendo").alias("url"))
    return shaped(rows, "merinohermanos", "seq")


def habitamos(pages: DataFrame, details: DataFrame | None = None) -> DataFrame:
    def cut(root: dom.Element) -> list[dict[str, str]]:
        out = []
        for card in root.all(cls="card"):
            link = card.one("a", has="href")
            out.append({"text": card.text(" ", True), "heading": _own(card.one("h6")), "url": link.attributes["href"] if link else ""})
        return out

    heading, base = _said("heading"), "https://en.habitamos.com.co"
    marker = F.regexp_extract(heading, "^.* - Medell[ií]n - (.*)$", 1)
    rows = _cards(pages.filter(~F.contains(text("html"), F.lit(fixed.NO_MORE))), cut).select(
        "seq", normalize.compose_id("HBM", lines.code_near_label(_said("text"))).alias("id"), F.when(heading.contains(" - "), normalize.tipo(F.split_part(heading, F.lit(" - "), F.lit(1)))).otherwise("").alias("tipo"),
        lines.rent_near_label(_said("text")).alias("precio"), *(lines.near_label(_said("text"), labels).alias(f) for f, labels in fixed.FEATURES.items()), normalize.barrio(marker).alias("barrio"), normalize.url(_said("url"), base).alias("url"),
    )
    return shaped(rows, "habitamos", "seq")


def alnago(pages: DataFrame, details: DataFrame | None = None) -> DataFrame:
    def cut(root: dom.Element) -> list[dict[str, str]]:
        out = []
        for article in root.all("article"):
            links = [a.attributes["href"] for a in article.all("a", has="href") if "inmueble" in a.attributes["href"]]
            if links:
                out.append({"url": links[0], "text": article.text("\n")})
        return out

    f = _cards(pages, cut).select("seq", "c", F.explode(once(lines.lines(_said("text")), lines.pairs)).alias("f"))
    value = lambda k: text(F.try_element_at("f", F.lit(k)))
    rows = f.select(
        "seq", normalize.compose_id("ALN", value("codigo"), True).alias("id"), normalize.price(value("precio")).alias("precio"), *(whole(digits(value(k))).alias(c) for k, c in (("bedrooms", "habitaciones"), ("bathrooms", "banos"), ("garages", "parqueaderos"))),
        normalize.barrio(value("zona")).alias("barrio"), normalize.url(_said("url"), "https://alnago.com").alias("url"),
    )
    cards = shaped(rows, "alnago", "seq")
    if details is None:
        return cards
    texts = details.withColumn("_text", dom.visible_text_udf("html"))
    found = texts.select("pos", "url", F.inline(once(lines.lines(F.col("_text")), lines.detail_by_priority)))
    return merge.fill(cards, found, ("tipo", "area", "estrato"))


def albertoalvarez(pages: DataFrame, details: DataFrame | None = None) -> DataFrame:
    def cut(root: dom.Element) -> list[dict[str, str]]:
        return [{"json": t.text().strip()} for a in root.all("article") for t in a.all("textarea", "field-property")[:1]]

    kind = F.col("kind") if "kind" in pages.columns else F.lit("apartamentos")
    cards = _cards(pages, cut).withColumn("json", _said("json"))
    kinds = pages.select((F.col("pos").cast("long")).alias("_p"), kind.alias("_kind"))
    rows = json_cards(cards, "json", "seq").withColumn("_p", F.shiftright("seq", 32)).join(kinds, "_p")
    url = F.concat(F.lit("https://albertoalvarez.com/inmuebles/detalle/arrendamientos/"), F.col("_kind"), F.lit("/"), F.regexp_replace("id", "^AAL-", ""), F.lit("/"), F.col("slug"), F.lit("-medellin/"))
    return shaped(rows.withColumn("url", url), "albertoalvarez", "seq")


def delnorte(pages: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """Pages are payloads: an array of items, or an object whose data is one. On a pass for casas only that type stays."""
    items = "array<struct<codigo:string,tipo:string,valor:string,area:string,cuartos:string,barrio:string,link:string>>"
    body = F.when(F.ltrim(text("html")).startswith("["), F.concat(F.lit('{"data":'), F.col("html"), F.lit("}"))).otherwise(F.col("html"))
    kind = F.col("kind") if "kind" in pages.columns else F.lit("")
    found = pages.select("pos", kind.alias("_kind"), F.posexplode(F.from_json(body, f"data {items}")["data"]).alias("card", "x"))
    rows = rest_items(found.select(_seq(F.col("card")).alias("seq"), "_kind", "x.*"), "seq", "_kind")
    return shaped(rows.filter((F.col("_kind") != "casa") | (F.col("tipo") == "casa")), "arrendamientosdelnorte", "seq")


def coninsa(pages: DataFrame, details: DataFrame | None = None) -> DataFrame:
    return shaped(documents_of(pages.withColumn("seq", _seq(F.lit(0))), "html", "seq"), "coninsa", "seq")


@dataclass(frozen=True)
class Portal:
    """A portal's name and cards; how its pages are numbered (a function of the first page's html), and the pages of a sample."""

    name: str
    parse: Callable[..., DataFrame]
    total: Callable[[Column], Column] | None = None
    detailed: bool = False
    sample: int = 3
    #: A sample's cards, for a portal that has one page.
    sample_cards: int | None = None
    #: Whether a page isn't beyond the last, for portals that don't say how many they have.
    has_cards: Callable[[Column], Column] = lambda html: (strip(html) != "") & ~html.contains(fixed.NO_MORE)


REGISTRY = {
    p.name: p
    for p in (
        Portal("maxibienes", maxibienes, pagination.total_in_script), Portal("albertoalvarez", albertoalvarez), Portal("alnago", alnago, detailed=True, sample_cards=6), Portal("arrendamientosdelnorte", delnorte),
        Portal("arrendamientosmonserrate", monserrate, detailed=True, sample=2), Portal("arrendamientossantafe", santafe, pagination.current_page, True), Portal("arrendamientosvillacruz", villacruz),
        Portal("coninsa", coninsa), Portal("habitamos", habitamos), Portal("merinohermanos", merinohermanos), Portal("metrocasas", metrocasas, pagination.total_in_links), Portal("santillana", santillana, detailed=True),
    )
}


def pages_of(spark: SparkSession, portal: str, answers: Callable[[DataFrame], DataFrame], max_pages: int | None = None) -> DataFrame:
    """(pos, page, html) of a portal's pages, as many as it says it has.

    answers: gives (page, html) for a table of pages; fetch.bulk_fetch over a transport, or saved pages. The number
    comes from the first answer, from that to a page far beyond the last, or, where neither tells, from probes.
    """
    p = REGISTRY[portal]
    by_far = p.total is pagination.current_page
    total = None
    if p.total is not None:
        probe = discovery.FAR if by_far else 1
        total = answers(spark.range(1).select(F.lit(probe).alias("page"))).select(p.total(text("html")).alias("total"))
    if total is None or (by_far and not total.filter(F.col("total") >= discovery.FAR).isEmpty()):  # a site of more pages shows the far one itself
        total = discovery.discover(spark.range(1).select(F.lit(portal).alias("source")), ["source"], lambda asked: asked.join(answers(asked.select("page")), "page").select("source", "page", "html"), p.has_cards).select(F.col("pages").alias("total"))
    asked = pagination.numbered(total, F.col("total"), max_pages).select("page")
    return answers(asked).select((F.col("page") - 1).alias("pos"), "page", "html")


def collect(spark: SparkSession, portal: str, answers: Callable[[DataFrame], DataFrame], details: DataFrame | None = None, sample_only: bool = False, max_pages: int | None = None) -> DataFrame:
    """A portal's listings from its answers: how many pages it has, the pages, their cards, and the merged and validated listings."""
    most = min((x for x in (max_pages, REGISTRY[portal].sample if sample_only else None) if x), default=None)
    return scrape(portal, pages_of(spark, portal, answers, most), details, sample_only, max_pages)


def scrape(portal: str, pages: DataFrame, details: DataFrame | None = None, sample_only: bool = False, max_pages: int | None = None) -> DataFrame:
    """Listings of a portal's pages with their warnings, validated once, after the merge; a sample has its first pages and no details."""
    p = REGISTRY[portal]
    most = min(x for x in (max_pages, p.sample if sample_only else None, 1_000_000_000) if x)
    found = p.parse(pages.filter(F.col("pos") < most), None if sample_only else details)
    if sample_only and p.sample_cards:
        found = found.orderBy("seq").limit(p.sample_cards)
    return validate.corrected(found)
