import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from prediolake.plans import orchestrate, portals, report
from prediolake.plans.portals import REGISTRY, pages_of, scrape
from prediolake.schemas import STORED
from prediolake.sources import discovery
from prediolake.sources.dom import visible_text
from prediolake.sources.store import ListingStore

PAGES = {
    "maxibienes": '<div class="property"><h3>Apto<br>Estrato: 4</h3><div class="price"><span>$ 1.500.000</span></div><ul class="amenities"><li>Cod 123</li><li><i class="fa fa-compress"></i>55 m2</li><li><i class="fa fa-bed"></i>3</li></ul><div class="image"><span class="location">MEDELLIN - BELEN</span><a href="/p/1"></a></div></div>',
    "metrocasas": '<div data-property-id="9" data-property-url="/x" data-property-title="Casa en Laureles">$ 2.000.000 Área 80 Habitaciones 3 Cuartos de baño 2</div>',
    "arrendamientossantafe": '<div class="property-card"><div class="inner-card"><a href="/d/1">x</a></div><span class="id">REF: A11248</span><p class="tipo-inmueble">Tipo: Apartamento</p><div class="precio"><p>$1,600,000</p></div><span class="area">55m²</span><span class="alcobas">2</span><span class="garaje">1</span><div class="sector"><p class="d-inline">Ubicación: Cristo Rey</p></div></div><div class="property-card"><span class="id">REF: A9692</span></div>',
    "santillana": '<div class="property"><div class="title"><h2><a href="/i/77">x</a></h2></div><div class="body"><p>Tipo: Casa</p></div><div class="areaPrecio"><span>$ 900.000</span></div></div>',
    "arrendamientosmonserrate": '<ul><li class="product"><a href="/x">v</a><h2 class="t-Title">Envigado</h2>$ 1.000.000</li><li class="product"><a href="/y">v</a>sin precio</li></ul>',
    "arrendamientosvillacruz": '<div class="estate_itm"><p>COD: 5</p><p>En Arriendo</p><p>Apto</p><p>$ 700.000</p><p>60 m²</p><p>2 Alcobas</p><p>MEDELLIN - BELEN</p></div><div class="estate_itm"><p>COD: 5</p><p>$ 1</p></div><div class="estate_itm"><p>$ 3</p></div>',
    "merinohermanos": "<p>menu</p><p>$ 800.000</p><p>Casa</p><p>123</p><p>3 Alcobas</p><p>Area 90 m2</p><p>Arriendo - Belen</p><p>$ 5</p>",
    "habitamos": '<div class="card"><h6>Apartment - Medellín - Poblado</h6><a href="/z">x</a><p>Code: 44</p><p>Rental price: $ 1.200.000 Sale price: $ 9</p><p>Bedrooms: 2 Bathrooms: 1 Garage: 1</p></div>',
    "alnago": '<article><a href="/es/inmueble/3">v</a><p>Zona</p><p>Villa Hermosa</p><p>Precio</p><p>$1.300.000</p><p>Cod:</p><p>99</p><p>Bedrooms</p><p>2</p></article>',
    "albertoalvarez": '<article><textarea class="field-property">{"code": "8", "propertyType": "Casa Vivienda", "rentValue": 1000000, "builtArea": 50, "stratum": "4", "sectorName": "San José"}</textarea></article><article><textarea class="field-property">bad</textarea></article>',
    "arrendamientosdelnorte": json.dumps({"data": [{"codigo": "6", "tipo": "Casa", "valor": "$ 500.000", "area": "40 m<sup>2</sup>", "cuartos": "2", "barrio": "Norte", "link": "https://a"}]}),
    "coninsa": json.dumps({"data": {"searchAPISearch": {"result_count": 2, "documents": [{"code": "1", "property_type": "Casa finca", "field_lease_value": 2e6, "neighborhood": "poblado", "url": "/q"}, {"code": "2", "property_type": "Bodega"}]}}}),
}
EXPECTED = {
    "maxibienes": {"id": "MXB-123", "tipo": "apartamento", "precio": 1500000, "area": 55, "habitaciones": 3, "estrato": 4, "barrio": "Belen", "url": "https://www.maxibienes.com/p/1"},
    "metrocasas": {"id": "MTC-9", "tipo": "casa", "precio": 2000000, "area": 80, "habitaciones": 3, "banos": 2, "barrio": "Laureles", "url": "https://metrocasas.co/x"},
    "arrendamientossantafe": {"id": "ASF-A11248", "tipo": "apartamento", "precio": 1600000, "area": 55, "habitaciones": 2, "parqueaderos": 1, "barrio": "Cristo Rey"},
    "santillana": {"id": "STL-77", "tipo": "casa", "precio": 900000},
    "arrendamientosmonserrate": {"id": "", "precio": 1000000, "barrio": "Envigado", "url": "https://arrendamientosmonserrate.com/x"},
    "arrendamientosvillacruz": {"id": "AVC-5", "tipo": "apartamento", "precio": 700000, "area": 60, "habitaciones": 2, "barrio": "Belen"},
    "merinohermanos": {"id": "MHR-123", "tipo": "casa", "precio": 800000, "area": 90, "habitaciones": 3, "barrio": "Belen"},
    "habitamos": {"id": "HBM-44", "tipo": "apartamento", "precio": 1200000, "habitaciones": 2, "banos": 1, "parqueaderos": 1, "barrio": "Poblado"},
    "alnago": {"id": "ALN-99", "precio": 1300000, "habitaciones": 2, "barrio": "Villa Hermosa"},
    "albertoalvarez": {"id": "AAL-8", "tipo": "casa", "precio": 1000000, "area": 50, "estrato": 4, "barrio": "San José", "url": "https://albertoalvarez.com/inmuebles/detalle/arrendamientos/apartamentos/8/san-josé-medellin/"},
    "arrendamientosdelnorte": {"id": "ADN-6", "tipo": "casa", "precio": 500000, "area": 40, "habitaciones": 2, "barrio": "Norte"},
    "coninsa": {"id": "CON-1", "tipo": "casa", "precio": 2000000, "barrio": "Poblado", "url": "https://www.coninsa.co/q"},
}


def pages(spark, portal):
    return spark.createDataFrame([(0, PAGES[portal]), (1, "")], "pos int, html string")


@pytest.mark.parametrize("portal", sorted(REGISTRY))
def test_cards(spark, portal):
    rows = scrape(portal, pages(spark, portal)).collect()
    assert len(rows) == 1 and rows[0]["portal"] == portal
    assert {k: rows[0][k] for k in EXPECTED[portal]} == EXPECTED[portal]


DETAILS = {
    "santillana": ("https://www.santillana.com.co/i/77", '<ul class="list-li"><li>Área Construida: 70 m²</li><li>Alcobas: 3</li><li>Baños: 2</li><li>Garaje: Doble</li><li>Estrato: V</li><li>Zona / barrio: belen</li></ul>', {"area": 70, "habitaciones": 3, "parqueaderos": 2, "estrato": 5, "barrio": "Belen"}),
    "arrendamientossantafe": ("https://www.arrendamientossantafe.com/d/1", "<p>Baños: <b>2</b></p><p>Estrato 3</p>", {"banos": 2, "estrato": 3, "habitaciones": 2}),
    "arrendamientosmonserrate": ("https://arrendamientosmonserrate.com/x", "<p>Código: 881</p><p>Tipo de inmueble</p><p>Casa</p><p>Área: 80 m² aprox.</p><p>Garaje 1</p>", {"id": "MNS-881", "tipo": "casa", "area": 80, "parqueaderos": 1, "barrio": "Envigado"}),
    "alnago": ("https://alnago.com/es/inmueble/3", "<style>x</style><h1>Apartment en arriendo en Y</h1><p>Área privada</p><p>110 M2</p><p>Bonito estrato 4.</p>", {"tipo": "apartamento", "area": 110, "estrato": 4, "habitaciones": 2}),
}


@pytest.mark.parametrize("portal", sorted(DETAILS))
def test_details(spark, portal):
    url, html, expected = DETAILS[portal]
    row = scrape(portal, pages(spark, portal), spark.createDataFrame([(0, url, html)], "pos int, url string, html string")).first()
    assert {k: row[k] for k in expected} == expected


def test_visible_text():
    assert visible_text("<div>a<script>x</script><br>b</div><p> </p><p>c &amp; d</p>") == "a\nb\nc & d" and visible_text(None) == ""


def test_run_all(spark, tmp_path):
    store = ListingStore(spark, str(tmp_path / "t"))
    names = ["metrocasas", "coninsa", "santillana"]

    def source(p):
        if p == "santillana":
            raise OSError("down")
        return pages(spark, p), None

    code, text = orchestrate.run_all(spark, source, store, names, now=datetime(2024, 5, 20), backup_folder=str(tmp_path))
    assert code == 1 and "coninsa: 1 listings (min 150)" in text and "santillana: FAILED" in text and "2 listings across 2 portals" in text
    assert all(len(line) in (52, 51) for line in text.splitlines() if "✅" not in line and "❌" not in line)
    assert {(r.id, r.ciudad, r.status) for r in store.read().collect()} == {("MTC-9", "medellin", "active"), ("CON-1", "medellin", "active")}
    assert orchestrate.verdict([], ["coninsa"])[0] is False
    assert orchestrate.export(store.read(), "MEDELLIN").count() == 2 and orchestrate.export(store.read(), "x").count() == 0


def test_report_duration():
    assert [report.duration(x) for x in (-1, 0.25, 59.9, 61)] == ["0s", "0.2s", "59s", "1m 1s"]


def test_load_file(spark, tmp_path):
    store = ListingStore(spark, str(tmp_path / "t"))
    path = tmp_path / "a.json"
    path.write_text(json.dumps([{"id": "A-1", "portal": "p", "tipo": "casa", "barrio": "X", "url": "https://x", "precio": 5}, {"id": "A-2", "portal": "p"}]))
    assert orchestrate.load_file(spark, str(path), " Medellin ", store) == {"rows": 2, "new": 2, "refreshed": 0, "flagged": 2, "inactive": 0}
    path.write_text(json.dumps([{"id": "A-2", "portal": "p"}]))
    assert orchestrate.load_file(spark, str(path), "medellin", store) == {"rows": 1, "new": 0, "refreshed": 1, "flagged": 1, "inactive": 1}
    assert orchestrate.main(spark, ["--store", str(tmp_path / "t"), "export", str(tmp_path / "out")]) == 0


def test_run_all_command(spark, tmp_path, capsys):
    cards = "".join(f"<article><a href='/inmueble/{k}'>x</a>Codigo: {k}\nPrecio: $ 1.{k}00.000</article>" for k in range(100, 109))
    spark.createDataFrame([(0, 1, cards)], "pos int, page int, html string").write.parquet(str(tmp_path / "pages" / "alnago.parquet"))
    spark.createDataFrame([], "pos int, url string, html string").write.parquet(str(tmp_path / "pages" / "alnago-details.parquet"))
    assert orchestrate.main(spark, ["--store", str(tmp_path / "t"), "run-all", "--pages", str(tmp_path / "pages"), "--portals", "alnago", "arrendamientosdelnorte", "--workers", "2"]) == 1
    assert "alnago" in capsys.readouterr().out
    pages = spark.read.parquet(str(tmp_path / "pages" / "alnago.parquet"))
    assert (scrape("alnago", pages, None, True).count(), scrape("alnago", pages).count()) == (6, 9)


def test_export_sheets(spark, tmp_path, capsys):
    table = spark.createDataFrame([("A-1", "p", "casa", 900_000, 1, 1, 1, 1, 1, "b", "u", "medellin", "active", datetime(2024, 1, 1))], STORED)
    target = str(tmp_path / "sheet")
    assert orchestrate.export_sheet(table, target, "bogota") == 0 and "No listings found" in capsys.readouterr().out and not (tmp_path / "sheet").exists()
    assert orchestrate.export_sheet(table, target, "MEDELLIN") == 0 and "Sheet updated" in capsys.readouterr().out
    assert spark.read.parquet(target).count() == 1
    assert orchestrate.export_sheet(table, str(tmp_path / "new"), title="May", new=True) == 0 and spark.read.parquet(str(tmp_path / "new" / "May")).count() == 1
    with pytest.raises(Exception, match="already exists"):
        orchestrate.export_sheet(table, str(tmp_path / "new"), title="May", new=True)


def test_short_names_and_public_names():
    import prediolake

    assert orchestrate.parser().parse_args(["--store", "s", "scrape", "adn", "--pages", "p"]).portal == "arrendamientosdelnorte"
    assert orchestrate.parser().parse_args(["--store", "s", "run-all", "--pages", "p", "--portals", "asf", "coninsa"]).portals == ["arrendamientossantafe", "coninsa"]
    assert all(callable(getattr(prediolake, name)) or name == "TIPO" for name in prediolake.__all__)


def test_long_pages_keep_their_order(spark):
    cards = "".join(f'<div data-property-id="{k}" data-property-title="Casa en X">$ 2.000.000</div>' for k in range(3))
    rows = scrape("metrocasas", spark.createDataFrame([(100_001, cards), (2, cards)], "pos int, html string")).orderBy("seq").select("seq", "id").collect()
    assert [r.id for r in rows] == ["MTC-0", "MTC-1", "MTC-2"] * 2 and [r.seq >> 32 for r in rows] == [2] * 3 + [100_001] * 3


@pytest.mark.parametrize("portal", ["habitamos", "arrendamientossantafe"])
def test_sites_of_more_pages_than_the_far_one(spark, portal, monkeypatch):
    monkeypatch.setattr(discovery, "FAR", 9)
    monkeypatch.setattr(discovery.discover, "__defaults__", (9, 8, 40))
    clamps = portal == "arrendamientossantafe"

    def answers(asked):
        shown = F.least(F.col("page"), F.lit(75)) if clamps else F.col("page")
        return asked.filter(F.lit(clamps) | (F.col("page") <= 75)).select("page", F.concat(F.lit("<p>card</p>"), F.concat(F.lit('<li class="current">'), shown, F.lit("</li>")) if clamps else F.lit("")).alias("html"))

    assert [r.page for r in pages_of(spark, portal, answers).orderBy("page").collect()] == list(range(1, 76))


def test_cards_of_few_pages_are_held_at_a_time(spark):
    def cut(root):
        return [{"k": e.text()} for e in root.all("b")]

    rows = portals._cards(spark.range(0, 100, 1, 1).select(F.col("id").alias("pos"), F.concat(F.lit("<b>"), F.col("id"), F.lit("</b><b>x</b>")).alias("html")), cut)
    assert rows._jdf.queryExecution().analyzed().toString().count("MapInPandas") == 1  # it yields the cards of PAGES pages; a function of whole batches held those of 10,000
    assert [(r.seq, r.c["k"]) for r in rows.orderBy("seq").collect()] == [(k << 32 | n, str(k) if n == 0 else "x") for k in range(100) for n in range(2)]


@pytest.mark.parametrize("portal", ["alnago", "arrendamientosdelnorte", "arrendamientosmonserrate", "arrendamientosvillacruz", "coninsa", "merinohermanos"])
def test_pages_without_numbers_are_asked_for_to_their_end(spark, portal, monkeypatch):
    monkeypatch.setattr(discovery.discover, "__defaults__", (9, 8, 40))

    def answers(asked):
        return asked.filter(F.col("page") <= 20).select("page", F.lit("<p>card</p>").alias("html"))

    assert [r.page for r in pages_of(spark, portal, answers).orderBy("page").collect()] == list(range(1, 21))


def test_a_site_is_made_once_and_its_own_pages_by_many_tasks(spark):
    """Its pages were gathered anew for each round of probes, and all of its detail pages read by as many tasks as the parts' file has pieces: one."""
    from prediolake.plans.queries import QUERIES

    plan = QUERIES["portal_alnago"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "RepartitionByExpression" in plan
