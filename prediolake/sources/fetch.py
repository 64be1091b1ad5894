"""Pages and payloads over a transport that is handed in, so that tests need no network."""

from __future__ import annotations

import base64
import json
import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: url -> (HTTP status, body)
Transport = Callable[[str], tuple[int, str]]

# Seconds waited before the second to fourth attempt, threads and pages at once; the status of too many
# requests and the seconds waited after it, at first and at most; how many pages are fetched in batches, and theirs.
WAITS = (1, 2, 4)
THREADS, CHUNK = 20, 200
BUSY, BUSY_WAIT, BUSY_MOST = 429, 5, 60
MANY, BATCH = 30, 25


def fetch_page(url: str, transport: Transport, sleep: Callable[[float], None] = time.sleep) -> str | None:
    """The page's text. 4xx: None at once, but 429, after which longer is waited; 5xx and exceptions: four attempts, then None; an empty body is ''."""
    for n, wait in enumerate((*WAITS, None)):
        try:
            status, body = transport(url)
            if status < 400:
                return body or ""
            if status == BUSY:
                wait = None if wait is None else min(BUSY_WAIT * 2**n, BUSY_MOST)
            elif status < 500:
                return None
        except Exception:  # any fault of the transport is retried like a server's
            pass
        if wait is not None:
            sleep(wait)
    return None


def fetch_batches(urls: Sequence[str], transport: Transport, sleep: Callable[[float], None] = time.sleep, threads: int = THREADS) -> Iterator[tuple[str, str | None]]:
    """(url, text) of one server's pages, in order. More than MANY go in batches of BATCH; while the server answers that it has too many requests, the next batch waits, twice as long each time, and what was refused is asked for again at its end, once.

    Faults of other kinds are those of fetch_page. The wait goes back to none after a batch that nothing was refused of.
    """
    size, wait = (BATCH if len(urls) > MANY else max(1, len(urls))), 0

    def one(url: str) -> tuple[str | None, bool]:
        refused = False

        def noting(u: str) -> tuple[int, str]:
            nonlocal refused
            answer = transport(u)
            refused = answer[0] == BUSY
            return (404, "") if refused else answer

        return fetch_page(url, noting, sleep), refused

    with ThreadPoolExecutor(threads) as pool:
        for at in range(0, len(urls), size):
            if wait:
                sleep(wait)
            part = list(urls[at : at + size])
            found = list(pool.map(one, part))
            refused = [k for k, (_, busy) in enumerate(found) if busy]
            wait = min(max(BUSY_WAIT, 2 * wait), BUSY_MOST) if refused else 0
            if refused:
                sleep(wait)
                for k in refused:
                    found[k] = one(part[k])
            yield from ((url, text) for url, (text, _) in zip(part, found, strict=True))


def fetch_json(url: str, transport: Transport, sleep: Callable[[float], None] = time.sleep) -> dict | list | None:
    """The payload, if it is an object or an array; anything else, invalid text too, is None without another attempt."""
    body = fetch_page(url, transport, sleep)
    try:
        value = json.loads(body) if body else None
    except ValueError:
        return None
    return value if isinstance(value, (dict, list)) else None


def inline(url: str) -> tuple[int, str]:
    """A transport for data: URLs, whose pages are in the URL itself; others are not found."""
    kind, comma, body = url.partition(",")
    if not comma or not kind.startswith("data:"):
        return 404, ""
    return 200, base64.b64decode(body).decode("utf-8", "replace") if kind.endswith(";base64") else unquote(body)


def fetch_graphql(query: str, variables: dict, post: Callable[[str], tuple[int, str]]) -> dict | None:
    """One POST, no retry; 400 and above, and text that isn't JSON: None."""
    status, body = post(json.dumps({"query": query, "variables": variables}))
    if status >= 400:
        return None
    try:
        return json.loads(body)
    except ValueError:
        return None


def _fetched(batches: Iterator[pd.DataFrame], transport: Transport) -> Iterator[pd.DataFrame]:
    with ThreadPoolExecutor(THREADS) as pool:
        for b in batches:
            for at in range(0, len(b), CHUNK):
                part = b.iloc[at : at + CHUNK]
                urls = list(dict.fromkeys(part["url"]))
                found = dict(zip(urls, pool.map(partial(fetch_page, transport=transport), urls), strict=True))
                yield pd.DataFrame({"pos": part["pos"], "url": part["url"], "html": [found[u] or "" for u in part["url"]]})


def bulk_fetch(urls: DataFrame, transport: Transport, tasks: int = 8) -> DataFrame:
    """(pos, url, html) for each (pos, url): '' where it failed; a URL that repeats in a chunk is fetched once. Order by pos to have the input's."""
    return urls.select("pos", "url").repartition(tasks).mapInPandas(partial(_fetched, transport=transport), "pos long, url string, html string")


class PageSource(DataSource):
    """spark.read.format('pages').option('urls', 'a\\nb').load(): (pos, url, html), with ``transport`` set on a subclass."""

    transport: Transport | None = None

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "pos long, url string, html string"

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self.options.get("urls", "").split("\n"), type(self).transport)


class PageReader(DataSourceReader):
    def __init__(self, urls: list[str], transport: Transport | None):
        self.urls, self.transport = [u for u in urls if u], transport

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(k) for k in range(0, max(1, len(self.urls)), CHUNK)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for k, url in enumerate(self.urls[partition.value : partition.value + CHUNK], partition.value):
            yield k, url, fetch_page(url, self.transport) or ""
