"""A searchable source of listing documents: filters and paging go to the source, over saved answers or over a service."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import unquote

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringContains

from ..schemas import GRAPHQL_DOCUMENT
from .fetch import fetch_graphql

#: The field whose values have a folder each, and fixed values: documents asked for at once, the query's text.
FOLDER, PAGE = "property_type", 200
QUERY = "query($fulltext: String, $conditions: JSON, $offset: Int, $limit: Int) { searchAPISearch(fulltext: $fulltext, conditions: $conditions, offset: $offset, limit: $limit) { result_count documents } }"
_NONE = "__HIVE_DEFAULT_PARTITION__"
_FIELDS = tuple(GRAPHQL_DOCUMENT.names)
_WHOLE = {f.name for f in GRAPHQL_DOCUMENT if f.dataType.simpleString() == "int"}
_REAL = {f.name for f in GRAPHQL_DOCUMENT if f.dataType.simpleString() == "double"}


def save_answers(documents: DataFrame, path: str) -> None:
    """Keep documents as answers: JSON lines, a folder for each property type."""
    documents.select(*_FIELDS).write.partitionBy(FOLDER).json(path)


class Answers:
    """Saved answers under a path of any file system that Arrow reaches."""

    def __init__(self, path: str):
        self.path = path

    def parts(self, conditions: dict[str, list]) -> list[dict]:
        """The files that may hold documents of the conditions."""
        system, root = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)
        out = []
        for info in system.get_file_info(fs.FileSelector(root, recursive=True)):
            name = info.path.rpartition("/")[2]
            if info.type == fs.FileType.File and name.endswith(".json") and not name.startswith(("_", ".")):
                kind = unquote(info.path.rpartition(f"{FOLDER}=")[2].partition("/")[0])
                kind = None if kind == _NONE else kind
                if FOLDER not in conditions or kind in conditions[FOLDER]:
                    out.append({"file": info.path, FOLDER: kind})
        return sorted(out, key=lambda p: p["file"])

    def documents(self, part: dict, conditions: dict[str, list], words: list[str]) -> Iterator[dict]:
        system = fs.FileSystem.from_uri(self.path)[0] if "://" in self.path or self.path.startswith("file:") else fs.LocalFileSystem()
        with system.open_input_stream(part["file"]) as stream:
            rest = b""
            while chunk := stream.read(1 << 20):
                *lines, rest = (rest + chunk).split(b"\n")
                yield from (json.loads(line) | {FOLDER: part[FOLDER]} for line in lines if line)
            if rest:
                yield json.loads(rest) | {FOLDER: part[FOLDER]}


class Service:
    """A search service: its answers tell how many documents there are, and each page is a part."""

    def __init__(self, post: Callable[[str], tuple[int, str]], words: str = "", page: int = PAGE):
        self.post, self.words, self.page = post, words, page

    def ask(self, conditions: dict[str, list], offset: int, limit: int) -> dict:
        """One answer; none, or one without the expected parts, has no documents."""
        variables = {"fulltext": self.words, "conditions": conditions, "offset": offset, "limit": limit}
        answer = fetch_graphql(QUERY, variables, self.post) or {}
        return ((answer.get("data") or {}).get("searchAPISearch")) or {}

    def parts(self, conditions: dict[str, list]) -> list[dict]:
        total = self.ask(conditions, 0, 1).get("result_count") or 0
        return [{"offset": at} for at in range(0, total, self.page)]

    def documents(self, part: dict, conditions: dict[str, list], words: list[str]) -> Iterator[dict]:
        yield from self.ask(conditions, part["offset"], self.page).get("documents") or []


class DocumentSource(DataSource):
    """spark.read.format('documents').option('path', folder).option('words', 'a b').load(): the documents that hold all words.

    Equality with constants, containment of a text in a column and presence are answered by the source; Spark pushes them where
    spark.sql.python.filterPushdown.enabled is on, and computes them itself elsewhere. A subclass with ``post`` asks a
    service in place of the folder.
    """

    post: Callable[[str], tuple[int, str]] | None = None

    @classmethod
    def name(cls) -> str:
        return "documents"

    def schema(self):
        return GRAPHQL_DOCUMENT

    def reader(self, schema) -> DataSourceReader:
        words = self.options.get("words", "")
        post = type(self).post
        return DocumentReader(Service(post, words) if post else Answers(self.options["path"]), words.lower().split())


class DocumentReader(DataSourceReader):
    def __init__(self, backend: Answers | Service, words: list[str]):
        self.backend, self.words = backend, words
        self.conditions: dict[str, list] = {}
        self.contained: list[tuple[str, str]] = []
        self.present: list[str] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            simple = isinstance(f, (EqualTo, In, IsNotNull, StringContains)) and len(f.attribute) == 1 and f.attribute[0] in _FIELDS
            if simple and isinstance(f, StringContains):
                self.contained.append((f.attribute[0], f.value))
            elif simple and isinstance(f, IsNotNull):
                self.present.append(f.attribute[0])
            elif simple and isinstance(f, EqualTo) and f.value is not None:
                self._narrow(f.attribute[0], [f.value])
            elif simple and isinstance(f, In) and None not in f.value:
                self._narrow(f.attribute[0], list(f.value))
            else:
                yield f

    def _narrow(self, field: str, values: list) -> None:
        before = self.conditions.get(field)
        self.conditions[field] = values if before is None else [v for v in before if v in values]

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.backend.parts(self.conditions)] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        """A backend may give more than was asked for: every condition is held against each document."""
        for doc in self.backend.documents(partition.value, self.conditions, self.words) if partition.value else ():
            if any(doc.get(field) is None for field in self.present) or any(doc.get(field) not in values for field, values in self.conditions.items()):
                continue
            if any(text not in (doc.get(field) or "") for field, text in self.contained):
                continue
            if self.words:
                said = " ".join(str(doc[c]) for c in _FIELDS if doc.get(c) is not None).lower()
                if any(w not in said for w in self.words):
                    continue
            yield tuple(None if doc.get(c) is None else int(doc[c]) if c in _WHOLE else float(doc[c]) if c in _REAL else str(doc[c]) for c in _FIELDS)


def load(spark: SparkSession, path: str, words: str = "") -> DataFrame:
    """Documents of saved answers, with filters pushed to them from now on in this session (which changes no result)."""
    spark.dataSource.register(DocumentSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("documents").option("path", path).option("words", words).load()


def page_of(documents: DataFrame, offset: int = 0, limit: int = PAGE, order: str = "code") -> DataFrame:
    """The documents from ``offset`` on, at most ``limit``, in the order of a column."""
    return documents.orderBy(F.col(order)).offset(offset).limit(limit)
