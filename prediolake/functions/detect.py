"""Detection of fields on cards of portals without a mapping: strategies in order, the first that finds something stays.

What none finds is 0 or '', and flags say what was seen and not used; nothing is invented.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .normalize import barrio, code_from_url, tipo
from .text import digits, number_in, strip, text, whole

_MONEY = r"(?:\$|COP|USD)\s*\d[\d.,]*"
_RENT = r"(?iu)(?:precio|canon|valor|arriendo|rent|price|alquiler)"
_METRES = r"(?iu)(\d+)\s*(?:m²|mts²|mt2|m2|metros)"
_OTHER_UNITS = r"(?iu)\d\s*(?:sq\s?ft|sqft|ft²|hect[aá]reas?|fanegadas?)"
COUNTS = {
    "habitaciones": ("alcoba", "habitaci[oó]n", "dormitorio", "cuarto", "bedroom"),
    "banos": ("baño", "bano", "bathroom", "wc"),
    "parqueaderos": ("parqueadero", "garaje", "estacionamiento", "parking"),
}


def price(card: Column) -> Column:
    """Of several amounts, the one right after a rental word; else the first with a currency sign; else a number right after a rental word."""
    s = text(card)
    marked = F.regexp_extract(s, _RENT + r"[^\d$/]{0,20}(" + _MONEY + ")", 1)
    plain = F.regexp_extract(s, _RENT + r"[^\d$/]{0,20}(\d[\d.,]*)", 1)
    return whole(digits(F.coalesce(F.nullif(marked, F.lit("")), F.nullif(F.regexp_extract(s, _MONEY, 0), F.lit("")), plain)), "bigint")


def area(card: Column) -> Column:
    """A number right before square metres; other units aren't converted."""
    return number_in(text(card), _METRES)


def area_flag(card: Column) -> Column:
    """What is odd about the area: 0 written out, or a unit that isn't converted; '' if nothing."""
    s = text(card)
    return F.when(s.rlike(_METRES) & (area(card) == 0), "zero area").when(~s.rlike(_METRES) & s.rlike(_OTHER_UNITS), "other unit").otherwise("")


def count(card: Column, field: str) -> Column:
    """A one- or two-digit number right before or after one of the field's words."""
    words = "(?:" + "|".join(COUNTS[field]) + ")"
    before, after = F.regexp_extract(text(card), rf"(?iu)\b(\d{{1,2}})\s*{words}", 1), F.regexp_extract(text(card), rf"(?iu){words}\p{{L}}*\s*:?\s*(\d{{1,2}})\b", 1)
    return whole(F.coalesce(F.nullif(before, F.lit("")), after))


def labelled(card: Column, *labels: str) -> Column:
    """The line's rest after one of the labels and a colon."""
    return strip(F.regexp_extract(text(card), rf"(?iu)(?:{'|'.join(labels)})\s*:\s*([^\n|]+)", 1))


def kind(card: Column, url: Column) -> Column:
    """Type after its label, else a URL part that names one, else an image's text."""
    in_url = F.regexp_extract(text(url), r"(?i)/(apartamento|casa|apartaestudio|local|oficina|bodega|lote|finca)s?(?:/|-|$)", 1)
    in_image = F.regexp_extract(text(card), r"(?iu)foto de (\p{L}+) en", 1)
    return tipo(F.coalesce(F.nullif(labelled(card, "tipo", "type", "property type"), F.lit("")), F.nullif(in_url, F.lit("")), in_image))


def place(card: Column) -> Column:
    return barrio(labelled(card, "ubicación", "barrio", "zona", "sector", "location"))


def level(card: Column) -> Column:
    return number_in(text(card), r"(?iu)estrato\s*:?\s*([1-6])\b")


def code(card: Column, url: Column) -> Column:
    """After a label, else the URL's last part if it has a digit; '' without."""
    last = code_from_url(url)
    return F.coalesce(F.nullif(F.regexp_extract(text(card), r"(?iu)(?:ref|código|codigo|code|id)\s*:\s*([\p{L}\d-]+)", 1), F.lit("")), F.when(last.rlike("[0-9]"), last), F.lit(""))


def generated_id(prefix: str, found: Column, row: Column) -> Column:
    """PREFIX-code, or PREFIX-row where no code was found."""
    return F.concat(F.lit(prefix + "-"), F.coalesce(F.nullif(found, F.lit("")), row.cast("string")))
