import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prediolake.functions import formats, normalize, text, validate


def column(spark, values, function, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"k int, v {kind}")
    return [r[0] for r in rows.orderBy("k").select(function(F.col("v"))).collect()]


CASES = {
    "price": [("$ 1.450.000", 1450000), ("$1,600,000", 1600000), ("Consultar precio", 0), ("$800.000 / $1.200.000", 800000), (None, 0), ("  ", 0), ("A convenir", 0), ("$1.200,50", 120050), ("/ $5", 0), ("-5", 5)],
    "tipo": [("APARTAMENTO", "apartamento"), ("Casa-Local", "casa"), ("Department", "apartamento"), ("ApartaEstudio", "apartaestudio"), (None, ""), (" Loft ", "loft"), ("CasaLocal", "casalocal"), ("Casa finca", "casa finca"), ("Penthouse-Duplex", "penthouse")],
    "estrato": [("V", 5), ("IV", 4), ("Comercial", 0), ("3", 3), ("8", 0), ("7", 7), ("3.0", 0), ("Estrato 3", 0), ("-1", 0), ("VII", 0), (None, 0)],
    "garaje": [("Cubierto", 1), ("Doble en paralelo", 2), ("No", 0), ("Zona de parqueo", 1), ("Sí", 1), ("Si.", 1), ("", 0), ("2", 2), ("dos", 0), (None, 0)],
    "barrio": [("Barrio: Loreto", "Loreto"), ("MEDELLIN - BELEN", "Belen"), ("EL POBLADO", "El Poblado"), ("Calle 10, laureles", "Laureles"), ("Barrio: A - B, c", "C"), ("2da etapa", "2Da Etapa"), (None, ""), (" SAN-JUAN O'BRIEN ", "San-Juan O'Brien")],
    "square_metres": [("110 M2", 110), ("282", 282), (None, 0), ("m2", 0)],
    "area_before_m": [("60 m<sup>2</sup> aprox.", 60), ("", 0), (None, 0), ("x", 0)],
    "code_from_url": [("https://a.co/x/y/12/", "12"), ("https://a.co", ""), ("", ""), (None, ""), ("/p/7?x=1", "7")],
    "slug": [("San José 2", "san-josé-2"), (None, "")],
    "encode_city": [("medellin", "Medell%C3%ADn"), ("Santa Fe/x", "Santa%20Fe/x")],
}


@pytest.mark.parametrize("name", CASES)
def test_goldens(spark, name):
    raw, expected = zip(*CASES[name], strict=True)
    assert column(spark, raw, getattr(normalize, name)) == list(expected)


def test_url(spark):
    base = "https://e.co/"
    raw = ["/p/1/", "//cdn/x", "p/1", "https://x.co/a", None]
    assert column(spark, raw, lambda c: normalize.url(c, base)) == ["https://e.co/p/1/", "https://e.co/cdn/x", "p/1", "https://x.co/a", ""]
    assert column(spark, ["/p"], lambda c: normalize.url(c, "")) == ["/p"]


def test_numbers_keep_their_level(spark):
    assert column(spark, [3, 8, 7, -1, None], normalize.estrato_number, "int") == [3, 0, 7, -1, 0]


def test_durations(spark):
    assert column(spark, [-1.0, 0.25, 59.9, 61.0], formats.duration, "double") == ["0s", "0.2s", "59s", "1m 1s"]
    assert column(spark, [0.5, 59.6, 61.0], formats.duration_rounded, "double") == ["0s", "60s", "1m 1s"]


def test_counts_in_output(spark):
    raw = ["Sample: 7 listing(s) extracted", "Scraped 12 listings from x", "a\nScraped 3 x\nSample: 9 y", "none", "Sample: x"]
    assert column(spark, raw, formats.listing_count) == [7, 12, 3, 0, 0]


def test_csv_values(spark):
    raw = [None, "N/A", "12", "12.0", "null", "NULL", " 7 "]
    rows = spark.createDataFrame(list(enumerate(raw)), "k int, v string").orderBy("k")
    assert [r[0] for r in rows.select(validate.sanitized("v", True)).collect()] == [0, 0, 12, 0, 0, 0, 7]
    assert [r[0] for r in rows.select(validate.sanitized("v", False)).collect()] == ["", "", "12", "12.0", "", "NULL", " 7 "]
    assert [r[0] for r in spark.createDataFrame([(12.7,)], "v double").select(validate.sanitized("v", True)).collect()] == [12]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_categories=("Cs",)), max_size=12), min_size=1, max_size=8))
def test_normalizers_are_total_and_settle(spark, values):
    once = column(spark, values, normalize.barrio)
    assert all(x is not None for x in once)
    assert [x.strip() for x in column(spark, once, normalize.barrio)] == [x.strip() for x in once] or any("," in x or " - " in x for x in values)
    assert all(x >= 0 for x in column(spark, values, normalize.price))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("abc ñÁé-'3x", max_size=12), min_size=1, max_size=8))
def test_title_is_pythons(spark, values):
    assert column(spark, values, text.title) == [v.title() for v in values]


def test_price_has_digits_of_every_script(spark):
    raw = ["$ ١٢٣٤٥٦", "१२३.४५६", "$ 1.２００.000 / 9", "Ⅳ ½ ²", "precio ৭"]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(raw)], "k int, raw string")
    found = {r.k: r.p for r in rows.select("k", normalize.price(F.col("raw")).alias("p")).collect()}
    plain = {k: int("".join(str(int(c)) for c in x.split("/")[0] if c.isdecimal()) or 0) for k, x in enumerate(raw)}
    assert found == plain
