"""Field values that the portals' notes give, by the normalizers that the portals use."""

import pytest
from pyspark.sql import functions as F

from prediolake.functions import normalize
from prediolake.functions.text import digits, whole
from prediolake.plans.extraction import title_split_of
from prediolake.plans.portals import scrape

GOLDENS = [
    (normalize.tipo, "Apartamento", "apartamento"),
    (normalize.price, "$1,600,000", 1_600_000),
    (lambda c: whole(digits(F.split_part(c, F.lit("m"), F.lit(1)))), "95 m2", 95),
    (normalize.barrio, "Laureles", "Laureles"),
    (lambda c: title_split_of(c)[0], "Apartamento en Laureles", "apartamento"),
    (lambda c: title_split_of(c)[1], "Apartamento en Laureles", "Laureles"),
    (lambda c: title_split_of(c)[0], "Apartaestudio La America", "apartaestudio"),
    (lambda c: title_split_of(c)[1], "Apartaestudio La America", "La America"),
    (normalize.tipo, "APARTAMENTO", "apartamento"),
    (normalize.price, "$2.500.000", 2_500_000),
    (lambda c: whole(digits(c)), "50 m²", 50),
    (normalize.garaje, "1", 1),
    (normalize.estrato, "3", 3),
    (normalize.estrato, "Comercial", 0),
    (normalize.barrio, "Robledo", "Robledo"),
    (normalize.barrio, "", ""),
]


@pytest.mark.parametrize("k", range(len(GOLDENS)))
def test_value(spark, k):
    function, raw, want = GOLDENS[k]
    assert spark.createDataFrame([(raw,)], "v string").select(function(F.col("v")).alias("x")).first().x == want


def test_fields_that_cards_lack(spark):
    """Cards of one portal have neither garages nor a level; details of another are conditional: absent means 0 or ''."""
    card = '<div data-property-id="118397" data-property-url="https://metrocasas.co/p/1" data-property-title="Apartamento en Laureles">Para alquiler $1,600,000 Área 95 m2 Habitaciones 2 Cuartos de baño 1</div>'
    row = scrape("metrocasas", spark.createDataFrame([(0, card)], "pos int, html string")).first()
    assert (row.id, row.tipo, row.precio, row.area, row.habitaciones, row.banos, row.parqueaderos, row.estrato, row.barrio, row.url) == ("MTC-118397", "apartamento", 1_600_000, 95, 2, 1, 0, 0, "Laureles", "https://metrocasas.co/p/1")
    page = '<div class="property"><div class="title"><h2><a href="https://www.santillana.com.co/i/5">x</a></h2></div><div class="body"><p>Tipo: APARTAMENTO</p></div><div class="areaPrecio"><span>$2.500.000</span></div></div>'
    detail = '<ul class="list-li"><li>Área Construida: 50 m²</li><li>Alcobas: 3</li><li>Estrato: Comercial</li></ul>'
    row = scrape("santillana", spark.createDataFrame([(0, page)], "pos int, html string"), spark.createDataFrame([(0, "https://www.santillana.com.co/i/5", detail)], "pos int, url string, html string")).first()
    assert (row.id, row.tipo, row.precio, row.area, row.habitaciones, row.banos, row.parqueaderos, row.estrato, row.barrio) == ("STL-5", "apartamento", 2_500_000, 50, 3, 0, 0, 0, "")
