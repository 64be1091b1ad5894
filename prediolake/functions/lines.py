"""Scans over a page's lines, as expressions on ARRAY<STRING>: a page stays one row, so nothing is shuffled or sorted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed
from . import normalize
from .text import before_labels, digits, look_up, number_in, strip, text, whole

Test = Callable[[Column], Column]


def lines(page: Column) -> Column:
    """The trimmed lines of a text that aren't empty."""
    return F.filter(F.transform(F.split(text(page), "\n"), strip), lambda x: x != "")


def html_lines(html: Column) -> Column:
    """Text of a page by patterns: lines end at block tags, other tags and runs of blanks become one blank, the commonest references are decoded. Script and style content stays."""
    s = text(html)
    for tag in fixed.LINE_TAGS:
        s = F.replace(s, F.lit(tag), F.lit(tag + "\n"))
    s = F.regexp_replace(F.regexp_replace(s, "<[^>]+>", " "), "[ \\t]+", " ")
    for name, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        s = F.replace(s, F.lit(name), F.lit(sign))
    return s


def first(found: Column) -> Column:
    return F.try_element_at(found, F.lit(1))


def last(found: Column) -> Column:
    return F.try_element_at(found, F.lit(-1))


def values(rows: Column, value: Callable[[Column, Column], Column]) -> Column:
    """Of each line, with its place from 0, the value; nulls are left out."""
    return F.filter(F.transform(rows, value), lambda x: x.isNotNull())


def after(rows: Column, at: Column) -> Column:
    """The line after a place; null after the last."""
    return F.get(rows, at + 1)


def label_value(rows: Column, *labels: str) -> Column:
    """The value of the first line that bears one of the labels: after its colon, on the next line if the label stands alone, or after a blank."""
    def of(label: str, x: Column, at: Column) -> Column:
        low = F.lower(x)
        colon = F.nullif(strip(F.regexp_replace(x, "^[^:]*:", "")), F.lit(""))
        rest = F.nullif(strip(F.substring(x, F.lit(len(label) + 1), F.length(x))), F.lit(""))
        return F.when(low.startswith(label + ":") | low.startswith(label + " :"), colon).when(low == label, after(rows, at)).when(low.startswith(label + " "), rest)

    return first(values(rows, lambda x, at: F.coalesce(*(of(label, x, at) for label in labels))))


def detail_labels(rows: Column) -> Column:
    """Struct of a detail page's fields; of a field's labels the first that the page has counts."""
    fields: dict[str, list[str]] = {}
    for label, field in fixed.DETAIL_LABELS.items():
        fields.setdefault(field, []).append(label)
    return F.struct(*[F.coalesce(label_value(rows, *names), F.lit("")).alias(field) for field, names in fields.items()])


def labelled_item(items: Column, *labels: str) -> Column:
    """What follows the colon of the last item that begins with one of the labels; '' without."""
    def begins(x: Column) -> Column:
        out = F.lit(False)
        for label in labels:
            out = out | x.startswith(label + ":")
        return out

    return F.coalesce(strip(F.regexp_replace(last(F.filter(items, begins)), "^[^:]*:", "")), F.lit(""))


def split_cards(rows: Column, starts: Test) -> Column:
    """Arrays of lines: a new one begins at each line that ``starts``, and at the first."""
    at = F.filter(F.transform(rows, lambda x, k: F.when(starts(x) | (k == 0), k)), lambda k: k.isNotNull())
    return F.transform(at, lambda k, j: F.slice(rows, k + 1, F.coalesce(F.get(at, j + 1), F.size(rows)) - k))


def starts_with_price(x: Column) -> Column:
    return x.startswith("$") & x.rlike("[0-9]")


def ruled_card(rows: Column) -> Column:
    """Struct of a card whose lines are told apart by a chain of rules: price, rooms, baths, area, barrio, code, and the first other line is the type."""
    low = F.lower
    rules: list[Test] = [
        starts_with_price, lambda x: low(x).contains("alcoba"), lambda x: low(x).contains("baño"), lambda x: low(x).startswith("area "),
        lambda x: x.contains(" - "), lambda x: x.rlike("^[0-9]+$"), lambda x: F.lit(True),
    ]

    def of(rule: int, value: Test) -> Column:
        def chosen(x: Column, _: Column) -> Column:
            earlier = F.lit(False)
            for r in rules[:rule]:
                earlier = earlier | r(x)
            return F.when(~earlier & rules[rule](x), value(x))

        return values(rows, chosen)

    count = lambda x: F.nullif(F.regexp_extract(x, r"^([0-9]+)(?:\s|$)", 1), F.lit("")).try_cast("int")
    word = lambda x: F.nullif(F.regexp_extract(x, r"(?:^|\s)([0-9]+)(?=\s|$)", 1), F.lit("")).try_cast("int")
    zero, none = F.lit(0), F.lit("")
    return F.struct(
        F.coalesce(last(of(0, normalize.price)), F.lit(0).cast("bigint")).alias("precio"), F.coalesce(last(of(1, count)), zero).alias("habitaciones"), F.coalesce(last(of(2, count)), zero).alias("banos"),
        F.coalesce(last(of(3, word)), zero).alias("area"), F.coalesce(last(of(4, lambda x: strip(F.substring_index(x, " - ", -1)))), none).alias("barrio"),
        F.coalesce(last(of(5, lambda x: x)), none).alias("codigo"), F.coalesce(first(of(6, lambda x: x)), none).alias("tipo"),
    )


def structural(card: Column) -> Column:
    """How many of the six fields that make a listing the card has."""
    said = [F.coalesce(card[c] != "", F.lit(False)) for c in ("codigo", "barrio", "tipo")] + [card[c] != 0 for c in ("banos", "habitaciones", "area")]
    total = F.lit(0)
    for x in said:
        total = total + x.cast("int")
    return total


def stateful_card(rows: Column) -> Column:
    """Struct of a card read line by line: first code, price and barrio; last type, area, rooms, baths and parking."""
    def number(pattern: str) -> Column:
        return F.coalesce(last(values(rows, lambda x, _: F.nullif(F.regexp_extract(x, pattern, 1), F.lit("")).try_cast("int"))), F.lit(0))

    area = values(rows, lambda x, k: F.when(x.rlike("[0-9]+\\s*m²"), number_in(x, "([0-9]+)\\s*m²")).when((after(rows, k) == "m²") & x.rlike("^[0-9]+$"), whole(x)))
    kind = values(rows, lambda x, k: F.when(x.contains("Arriendo"), after(rows, k)))
    price = values(rows, lambda x, _: F.when(x.contains("$"), F.nullif(normalize.price(x), F.lit(0).cast("bigint"))))
    place = values(rows, lambda x, _: F.when(x.contains(" - "), F.nullif(normalize.barrio(x), F.lit(""))))
    code = values(rows, lambda x, _: F.nullif(F.regexp_extract(x, "COD:\\s*([0-9]+)", 1), F.lit("")))
    return F.struct(
        F.coalesce(first(code), F.lit("")).alias("codigo"), normalize.tipo(last(kind)).alias("tipo"), F.coalesce(first(price), F.lit(0).cast("bigint")).alias("precio"), F.coalesce(last(area), F.lit(0)).alias("area"),
        number("([0-9]+)\\s*Alcobas").alias("habitaciones"), number("([0-9]+)\\s*Baños").alias("banos"), number("([0-9]+)\\s*parq\\.?").alias("parqueaderos"), F.coalesce(first(place), F.lit("")).alias("barrio"),
    )


def near_label(card: Column, labels: tuple[str, ...]) -> Column:
    """Digits of the word after the first of the labels that the text has, whatever its case; 0 without."""
    out = F.lit(0)
    for label in reversed(labels):
        at = F.instr(F.lower(card), label.lower())
        word = F.regexp_extract(F.substring(card, at + len(label), F.length(card)), r"^\s*(\S+)", 1)
        out = F.when(at > 0, whole(digits(word))).otherwise(out)
    return out


def rent_near_label(card: Column) -> Column:
    """The rent after its label, or after the first '$', before any label of a sale; 0 without."""
    chunk = F.when(F.instr(card, "$") > 0, F.substring(card, F.instr(card, "$"), F.length(card)))
    for label in reversed(fixed.RENT_LABELS):
        at = F.instr(card, label)
        chunk = F.when(at > 0, strip(F.substring(card, at + len(label), F.length(card)))).otherwise(chunk)
    return normalize.price(before_labels(chunk, fixed.SALE_LABELS))


def code_near_label(card: Column) -> Column:
    """The number right after a code label; '' without."""
    out = F.lit("")
    for label in reversed(fixed.CODE_LABELS):
        at = F.instr(F.lower(card), label.lower())
        word = F.regexp_extract(F.substring(card, at + len(label), F.length(card)), r"^\s*([0-9]+)(?=\s|$)", 1)
        out = F.when((at > 0) & (word != ""), word).otherwise(out)
    return out


def detail_by_priority(rows: Column) -> Column:
    """Struct of a detail page: type from the first line on renting or selling, private area before land, level in the prose."""
    offer = first(F.filter(rows, lambda x: F.lower(x).contains("en arriendo") | F.lower(x).contains("en venta")))
    word = F.regexp_extract(F.lower(offer), r"^(\S+)", 1)
    def named(*names: str) -> Column:
        def value(x: Column, k: Column) -> Column:
            found = F.lit(False)
            for n in names:
                found = found | F.lower(x).contains(n)
            return F.when(found & after(rows, k).isNotNull(), normalize.square_metres(after(rows, k)))

        return values(rows, value)

    land = last(F.filter(named("área terreno", "area terreno"), lambda v: v > 0))
    level = normalize.estrato_number(number_in(F.array_join(rows, "\n"), r"(?iu)estrato\s+([0-9]+)"))
    return F.struct(normalize.tipo(look_up(fixed.DETAIL_TIPO, word, word)).alias("tipo"), F.coalesce(first(named("área privada", "area privada")), land, F.lit(0)).alias("area"), level.alias("estrato"))


def pairs(rows: Column) -> Column:
    """Map of a card whose lines are labels and values in turn: a label takes the next line with it; the first value of a field stays."""
    labels = F.create_map(*[F.lit(x) for pair in fixed.CARD_LABELS.items() for x in pair])
    start = F.struct(F.lit(False).alias("skip"), F.create_map().cast("map<string,string>").alias("found"))
    zipped = F.transform(rows, lambda x, k: F.struct(F.try_element_at(labels, F.lower(x)).alias("field"), after(rows, k).alias("next")))

    def step(state: Column, x: Column) -> Column:
        takes = ~state["skip"] & x["field"].isNotNull() & x["next"].isNotNull()
        new = takes & ~F.map_contains_key(state["found"], F.coalesce(x["field"], F.lit("")))
        return F.struct(takes.alias("skip"), F.when(new, F.map_concat(state["found"], F.create_map(F.coalesce(x["field"], F.lit("")), x["next"]))).otherwise(state["found"]).alias("found"))

    found = F.aggregate(zipped, start, step)["found"]
    inline = first(values(rows, lambda x, _: F.when(F.lower(x).rlike("^cod[: ]") & (F.length(x) > 4), strip(F.substring(x, 5, 1_000_000)))))
    return F.when(~F.map_contains_key(found, "codigo") & inline.isNotNull(), F.map_concat(found, F.create_map(F.lit("codigo"), F.coalesce(inline, F.lit(""))))).otherwise(found)
