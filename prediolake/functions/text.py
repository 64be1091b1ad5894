"""Text helpers that other expressions build on. Every input may be null; see each for what that gives."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def text(c: Column | str) -> Column:
    """As a string; null becomes ''."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(""))


#: Unicode's white space.
SPACES = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without Unicode white space at either end (trim() takes blanks alone)."""
    return F.btrim(c, F.lit(SPACES))


def strip_left(c: Column) -> Column:
    """Without Unicode white space at the beginning, for what has none at the end."""
    return F.ltrim(c, F.lit(SPACES))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """An array of use(value) alone, with the value computed once however often ``use`` takes it. Give it to inline or explode, whose columns filters aren't pushed below, so that it isn't computed for them again."""
    return F.transform(F.array(value), use)


def title(c: Column) -> Column:
    """Every run of letters capitalized, the rest lower. initcap() begins words after blanks alone: where a text has other signs, a mark with a blank goes between them and letters, and out again (what looks like the mark is told apart meanwhile)."""
    low, mark = F.lower(c), "\x01"
    plain = F.regexp_extract(low, r"\A[\p{L} ]*\z", 0) == low  # nearly all texts; functions over arrays, which aren't compiled, are for the others. Naming it twice here has it computed once
    parts = F.transform(F.regexp_extract_all(low, F.lit(r"([\p{L} ]+|[^\p{L} ]+)"), 1), lambda x: F.replace(x, F.lit(mark), F.lit(mark + "\x02")))
    words = F.initcap(F.when(plain, low).otherwise(F.array_join(parts, mark + " ")))
    return F.replace(F.replace(words, F.lit(mark + " "), F.lit("")), F.lit(mark + "\x02"), F.lit(mark))


def _decimal_digits() -> tuple[str, str]:
    """Every decimal digit of the basic plane that isn't ASCII, and what each stands for."""
    signs = [chr(k) for k in range(0x80, 0x10000) if unicodedata.category(chr(k)) == "Nd"]
    return "".join(signs), "".join(str(unicodedata.decimal(c)) for c in signs)


_OTHER_DIGITS = _decimal_digits()


def digits(c: Column) -> Column:
    """The decimal digits of a text, joined; '' if none."""
    return F.regexp_replace(c, r"[^0-9]+", "")


def ascii_digits(c: Column) -> Column:
    """The text with the decimal digits of any script as ASCII."""
    other = F.octet_length(c) != F.char_length(c)  # nearly all texts are spared the table
    return F.when(other, F.translate(c, *_OTHER_DIGITS)).otherwise(c)


def whole(c: Column, kind: str = "int") -> Column:
    """A text of digits as a number; '' and what doesn't fit: 0."""
    return F.coalesce(F.nullif(c, F.lit("")).try_cast(kind), F.lit(0).cast(kind))


def whole_digits(c: Column, kind: str = "int") -> Column:
    """whole() of what has digits alone, named once, so that it isn't made twice: with a 0 before it, '' is a number too."""
    return F.coalesce(F.concat(F.lit("0"), c).try_cast(kind), F.lit(0).cast(kind))


def number_in(c: Column, pattern: str, kind: str = "int") -> Column:
    """The first group of the pattern's first match, as a number; 0 without."""
    return whole(F.regexp_extract(c, pattern, 1), kind)


def look_up(table: Mapping[str, object], key: Column, default: Column | None = None) -> Column:
    """The table's value at the key, as an expression: small tables stay in the plan, without a join."""
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    found = F.try_element_at(pairs, key)
    return found if default is None else F.coalesce(found, default)


def any_of(c: Column, parts: Sequence[str]) -> Column:
    """Whether the text contains any of the parts."""
    out = F.lit(False)
    for p in parts:
        out = out | c.contains(p)
    return out


def before_labels(c: Column, labels: Sequence[str]) -> Column:
    """The text before the first label met, each cut in turn, whatever their case."""
    for label in labels:
        at = F.instr(F.lower(c), label.lower())
        c = F.when(at > 0, strip(F.substring(c, F.lit(1), at - 1))).otherwise(c)
    return c
