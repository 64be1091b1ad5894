"""A small tree of HTML elements on the standard library's parser, and texts of pages by it."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import fixed

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class Element:
    """A tag with its attributes and children, which are elements and texts."""

    def __init__(self, tag: str, attributes: dict[str, str], parent: Element | None = None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Element | str] = []

    @property
    def classes(self) -> list[str]:
        return self.attributes.get("class", "").split()

    def descend(self) -> Iterator[Element]:
        stack = [c for c in reversed(self.children) if isinstance(c, Element)]
        while stack:
            e = stack.pop()
            yield e
            stack.extend(c for c in reversed(e.children) if isinstance(c, Element))

    def all(self, tag: str | None = None, cls: str | None = None, has: str | None = None, test: Callable[[Element], bool] | None = None) -> list[Element]:
        """Elements below, in page order: by tag, by class, by an attribute, by a test."""
        return [e for e in self.descend() if (tag is None or e.tag == tag) and (cls is None or cls in e.classes) and (has is None or has in e.attributes) and (test is None or test(e))]

    def one(self, *path: tuple[str | None, str | None] | str, has: str | None = None) -> Element | None:
        """The first element at the end of a path of tags or (tag, class); ``has``: an attribute of the last."""
        found: list[Element] = [self]
        for k, step in enumerate(path):
            tag, cls = (step, None) if isinstance(step, str) else step
            found = [e for f in found for e in f.all(tag, cls, has if k == len(path) - 1 else None)]
        return found[0] if found else None

    def texts(self) -> Iterator[str]:
        stack: list[Element | str] = list(reversed(self.children))
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                yield c
            else:
                stack.extend(reversed(c.children))

    def text(self, join: str = "", strip: bool = False) -> str:
        parts = (t.strip() for t in self.texts()) if strip else self.texts()
        return join.join(t for t in parts if t)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {})

    def handle_starttag(self, tag: str, attrs: list) -> None:
        e = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(e)
        if tag not in _VOID:
            self.at = e

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.at.children.append(Element(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        e: Element | None = self.at
        while e is not None and e.tag != tag:
            e = e.parent
        if e is not None and e.parent is not None:
            self.at = e.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Element:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def visible_text(html: str | None) -> str:
    """Text without scripts, styles and frames; lines end at block elements and br, empty lines go."""
    out: list[str] = []

    def walk(e: Element) -> None:
        for c in e.children:
            if isinstance(c, str):
                out.append(c)
            elif c.tag == "br":
                out.append("\n")
            elif c.tag not in fixed.SKIPPED_TAGS:
                edge = c.tag in fixed.BREAK_TAGS
                if edge and out and out[-1] != "\n":
                    out.append("\n")
                walk(c)
                if edge and out and out[-1] != "\n":
                    out.append("\n")

    walk(parse(html))
    return re.sub(r"\n\s*\n", "\n", "".join(out)).strip()


@F.pandas_udf(StringType())
def visible_text_udf(html: pd.Series) -> pd.Series:
    return html.map(visible_text)
