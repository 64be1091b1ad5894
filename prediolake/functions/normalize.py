"""Normalizers: a raw value in, a number or a text out, never null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed
from .text import SPACES, ascii_digits, digits, look_up, strip, strip_left, text, title, whole, whole_digits


def price(raw: Column) -> Column:
    """Decimal digits, of any script, of the part before the first '/', joined; 0 for null, blank, 'consultar precio' and no digits."""
    s = text(raw)
    hidden = F.lower(s).contains("consultar precio")
    return F.when(hidden, F.lit(0).cast("bigint")).otherwise(whole_digits(digits(F.substring_index(ascii_digits(s), "/", 1)), "bigint"))


def tipo(raw: Column) -> Column:
    """The canonical type of a name, else of the part before its first '-', else that name in lower case."""
    low = F.lower(strip(text(raw)))
    first = strip(F.substring_index(low, "-", 1))
    return F.coalesce(look_up(fixed.TIPO, low), F.when(low.contains("-"), look_up(fixed.TIPO, first, first)), low)


def estrato(raw: Column) -> Column:
    """Level of a text: roman numerals i to vi, or digits; 8, comercial and anything else: 0."""
    low = F.lower(strip(text(raw)))
    told = whole_digits(F.regexp_extract(low, "^(?!0*8$)[0-9]+$", 0))
    return F.greatest(look_up(fixed.ROMAN, low), told).cast("int")  # one of both is 0 or null; both are made of a text that is trimmed once


def estrato_number(value: Column) -> Column:
    """Level of a number: kept as it is, but for 8 and null, which are 0."""
    return F.coalesce(F.when(value == 8, 0).otherwise(value), F.lit(0)).cast("int")


def garaje(raw: Column) -> Column:
    """Places of a text: by the table of descriptions, or digits; anything else: 0."""
    low = F.lower(strip(text(raw)))
    return F.coalesce(look_up(fixed.GARAJE, low), F.when(low.rlike("^[0-9]+$"), whole(low)), F.lit(0)).cast("int")


def barrio(raw: Column) -> Column:
    """The last part after ' - ', then after ',', without a leading 'barrio:', in title case."""
    s = strip(text(raw))
    s = F.regexp_replace(s, f"(?i)^barrio:[{SPACES}]*", "")
    s = F.substring_index(s, " - ", -1)
    return title(strip_left(F.substring_index(s, ",", -1)))  # all parts end as the trimmed text does


def url(raw: Column, base: Column | str) -> Column:
    """A path from the root joined to the base with one '/'; other texts trimmed."""
    s, base = strip(text(raw)), F.lit(base) if isinstance(base, str) else base
    return F.when(s.startswith("/") & (base != ""), F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), F.ltrim(s, F.lit("/")))).otherwise(s)


def encode_city(raw: Column) -> Column:
    """The city's accepted spelling, percent-encoded; blanks as %20, slashes kept."""
    s = strip(text(raw))
    name = look_up(fixed.CITIES, F.lower(s), s)
    return F.replace(F.replace(F.url_encode(name), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))


def slug(raw: Column) -> Column:
    """Lower case, blanks as '-', only letters, digits and '-'."""
    return F.regexp_replace(F.replace(F.lower(strip(text(raw))), F.lit(" "), F.lit("-")), r"[^\p{L}\p{N}-]", "")


def compose_id(prefix: str, code: Column, always: bool = False) -> Column:
    """PREFIX-code; '' without a code, unless the portal always composes."""
    made = F.concat(F.lit(prefix + "-"), text(code))
    return made if always else F.when(text(code) == "", "").otherwise(made)


def repair_id(id_: Column, portal: Column) -> Column:
    """An id that holds a price label is made anew of the portal and its first digits, where it has any."""
    low, code = F.lower(text(id_)), F.regexp_extract(text(id_), r"(\d+)", 1)
    bad = low.contains("rent:") | low.contains("sale:") | low.contains("$")
    return F.when(bad & (code != "") & (text(portal) != ""), F.concat(F.upper(F.left(portal, F.lit(3))), F.lit("-"), code)).otherwise(text(id_))


def repair_url(raw: Column) -> Column:
    """Without the English subdomain of one portal."""
    return F.replace(text(raw), F.lit("en.habitamos.com.co"), F.lit("habitamos.com.co"))


def strip_parameter(raw: Column, name: str) -> Column:
    """A URL without one query parameter, wherever it stands."""
    s = F.regexp_replace(text(raw), rf"([?&]){name}=[^&#]*", "$1")
    s = F.regexp_replace(F.regexp_replace(s, r"([?&])&+", "$1"), r"[?&]+(#|$)", "$1")
    return s


def area_before_m(raw: Column) -> Column:
    """Digits before the first 'm' of a text without tags."""
    return whole(digits(F.split_part(F.regexp_replace(text(raw), "<[^>]+>", ""), F.lit("m"), F.lit(1))))


def square_metres(raw: Column) -> Column:
    """Digits up to the first blank or m; a text that begins with other signs keeps its digits."""
    return whole(digits(F.regexp_extract(strip(text(raw)), r"^([^ Mm]*)", 1)))


def code_from_url(raw: Column) -> Column:
    """The last part of the path; '' for none."""
    path = F.regexp_extract(text(raw), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.substring_index(F.regexp_replace(path, "/+$", ""), "/", -1)
