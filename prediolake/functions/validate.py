"""Row rules: messages beside the corrected columns, as expressions over a listing's columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from . import normalize
from .text import SPACES, any_of, strip, text

# The least and largest price that isn't remarkable, the loader's largest, and the largest of each measure.
LEAST, MOST, LOADER_MOST = 100_000, 50_000_000, 500_000_000
LIMITS = (("parqueaderos", 10), ("habitaciones", 30), ("banos", 20), ("area", 10_000))


def _say(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _messages(*rules: tuple[Column, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(when, message) for when, message in rules]))


def _too_low() -> Column:
    return (F.col("precio") > 0) & (F.col("precio") < LEAST)


def _code_in_barrio() -> Column:
    return any_of(F.lower("barrio"), ("código:", "codigo:"))


def warnings() -> Column:
    """Messages on a listing, in the order of the rules; they see the values before correction."""
    precio, estrato = F.col("precio"), F.col("estrato")
    high = {"parqueaderos": " > 10 (anomaly)"}
    return _messages(
        (_too_low(), _say("precio=", precio, " set to 0 (below floor)")),
        (precio > MOST, _say("precio=", precio, " unusually high")),
        (_code_in_barrio(), _say("barrio='", F.col("barrio"), "' salvaged to first segment")),
        (estrato == 8, _say("estrato=", estrato, " = 8 (commercial?)")),
        ((estrato > 6) & (estrato != 8), _say("estrato=", estrato, " > 6 (source data error)")),
        *((F.col(c) > limit, _say(f"{c}=", F.col(c), high.get(c, " suspiciously high"))) for c, limit in LIMITS),
        ((F.col("tipo") != "") & ~F.lower("tipo").isin(*fixed.STANDARD_TIPOS), _say("tipo='", F.col("tipo"), "' non-standard")),
        ((F.col("id") != "") & ~F.col("id").contains("-"), _say("id='", F.col("id"), "' invalid format")),
        ((F.col("url") != "") & ~F.col("url").rlike("^https?://"), _say("url='", F.col("url"), "' invalid format")),
    )


def corrected(df: DataFrame) -> DataFrame:
    """Listings with ``warnings`` and the corrections: prices below the floor are 0, a barrio with a code keeps its first word."""
    first = F.element_at(F.split(strip(F.col("barrio")), r"(?U)\s+"), 1)
    return df.withColumns({"warnings": warnings(), "precio": F.when(_too_low(), F.lit(0)).otherwise(F.col("precio")).cast("bigint"), "barrio": F.when(_code_in_barrio(), first).otherwise(F.col("barrio"))})


def issues() -> Column:
    """Messages of the JSON loader, whose rules and limits differ from those of ``warnings``."""
    precio, barrio, url, id_, tipo = (F.col(c) for c in ("precio", "barrio", "url", "id", "tipo"))
    return _messages(
        (_too_low(), _say("precio=", precio, " too low → 0")),
        (precio > LOADER_MOST, _say("precio=", F.format_number(precio, 0), " unusually high")),
        (F.col("area") > 10_000, _say("area=", F.col("area"), " unusually high")),
        *((F.col(c) > limit, _say(f"{c}=", F.col(c), f" > {limit}")) for c, limit in (("habitaciones", 30), ("banos", 20), ("parqueaderos", 10))),
        (F.col("estrato") > 6, _say("estrato=", F.col("estrato"), " > 6 (Colombia max)")),
        (barrio == "", F.lit("barrio is empty")),
        (_artifact(barrio), _say("barrio contains artifacts: ", F.left(barrio, F.lit(60)))),
        ((url != "") & ~url.startswith("http"), _say("url not absolute: ", F.left(url, F.lit(50)))),
        (url.contains("en.habitamos"), F.lit("url has en. subdomain")),
        (url == "", F.lit("url is empty")),
        (id_ == "", F.lit("id is empty")),
        (any_of(F.lower(id_), fixed.ID_ARTIFACTS), _say("id contains price artifacts: ", id_)),
        (tipo == "", F.lit("tipo is empty")),
        (tipo.isin(*fixed.TRANSACTIONS), _say("tipo is transaction type, not property type: ", tipo)),
    )


def _artifact(barrio: Column) -> Column:
    return any_of(F.lower(barrio), fixed.BARRIO_ARTIFACTS)


def loaded(df: DataFrame) -> DataFrame:
    """Listings as the JSON loader stores them: ``issues`` and its repairs of price, barrio, url and id."""
    return df.withColumns(
        {
            "issues": issues(),
            "precio": F.when(_too_low(), F.lit(0)).otherwise(F.col("precio")).cast("bigint"),
            "barrio": F.when(_artifact(F.col("barrio")), strip(F.split_part("barrio", F.lit("."), F.lit(1)))).otherwise(F.col("barrio")),
            "url": normalize.repair_url(F.col("url")),
            "id": normalize.repair_id(F.col("id"), F.col("portal")),
        }
    )


#: A marker with white space about it.
_MARKER = rf"\A[{SPACES}]*(?:{'|'.join(fixed.MARKERS)})[{SPACES}]*\z"


def _is_marker(c: Column) -> Column:
    """Whether a text is a marker, white space aside. Only texts that begin as markers do, or with white space or what isn't ASCII, are put to the pattern."""
    may_be = (c < "!") | (c >= "\x7f")
    for sign in sorted({m[0] for m in fixed.MARKERS}):
        may_be = may_be | c.startswith(sign)
    return may_be & c.rlike(_MARKER)


def _is_whole(value: Column) -> Column:
    """Whether it is a column of whole numbers: known before the query runs, so only one of two forms is computed."""
    return F.typeof(value).rlike("^(tinyint|smallint|int|bigint)$")


def sanitized(c: str | Column, numeric: bool) -> Column:
    """A CSV value: null and markers are 0 or ''; numbers are cut to whole ones, texts that aren't whole numbers are 0."""
    value = F.col(c) if isinstance(c, str) else c
    marker = _is_marker(text(value))
    if not numeric:
        return F.when(marker, "").otherwise(text(value))
    number = F.when(marker, None).otherwise(strip(text(value)))
    as_whole = value.cast("string").try_cast("bigint")
    fraction = F.typeof(value).rlike("^(double|float|decimal)")
    told = F.coalesce(F.when(number.rlike(r"^[+-]?[0-9]+$"), number.try_cast("bigint")).when(fraction, number.try_cast("double").try_cast("bigint")), F.lit(0).cast("bigint"))
    return F.when(_is_whole(value), F.coalesce(as_whole + (as_whole == -1).cast("bigint"), F.lit(0).cast("bigint"))).otherwise(told)  # of the markers only -1 is a whole number; a condition's branches would make it again


def sanitized_digits(name: str) -> Column:
    """A number's CSV value as text; whole numbers are put in words once, not read back."""
    told = F.col(name).cast("string")
    return F.when(_is_whole(F.col(name)), F.coalesce(F.nullif(told, F.lit("-1")), F.lit("0"))).otherwise(sanitized(name, True).cast("string"))
