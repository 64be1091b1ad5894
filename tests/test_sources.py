import csv
import json

import pytest
from pyspark.sql import functions as F

from prediolake.schemas import LISTING, STORED
from prediolake.sources import fetch, files, pagination
from prediolake.sources.store import ListingStore
from prediolake.streaming.upserts import follow


class Replies:
    def __init__(self, *replies):
        self.replies, self.calls = list(replies), 0

    def __call__(self, url):
        self.calls += 1
        r = self.replies.pop(0)
        if isinstance(r, Exception):
            raise r
        return r


def test_fetch_retries():
    waits = []
    t = Replies((500, ""), OSError(), (503, ""), (200, "ok"))
    assert fetch.fetch_page("u", t, waits.append) == "ok" and waits == [1, 2, 4]
    assert fetch.fetch_page("u", Replies((404, "x")), waits.append) is None
    t = Replies(*[(500, "")] * 4)
    assert fetch.fetch_page("u", t, waits.append) is None and t.calls == 4
    assert fetch.fetch_page("u", Replies((200, "")), waits.append) == ""


def test_fetch_json():
    one = lambda body: fetch.fetch_json("u", Replies((200, body)))
    assert one('{"a": 1}') == {"a": 1} and one("[1]") == [1] and one("3") is None and one("x") is None and one("") is None
    assert fetch.fetch_graphql("q", {}, lambda body: (400, "")) is None
    assert fetch.fetch_graphql("q", {"n": 1}, lambda body: (200, body)) == {"query": "q", "variables": {"n": 1}}


def local(url):
    return (404, "") if url == "b" else (200, f"<{url}>")


def test_bulk_fetch(spark):
    urls = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a")], "pos long, url string")
    assert [(r.pos, r.html) for r in fetch.bulk_fetch(urls, local, 2).orderBy("pos").collect()] == [(0, "<a>"), (1, ""), (2, "<a>")]


class LocalPages(fetch.PageSource):
    transport = staticmethod(local)


def test_data_source(spark):
    spark.dataSource.register(LocalPages)
    rows = spark.read.format("pages").option("urls", "a\nb").load().orderBy("pos").collect()
    assert [(r.pos, r.url, r.html) for r in rows] == [(0, "a", "<a>"), (1, "b", "")]


def test_pagination(spark):
    pages = {1: "x", 2: "xx", 3: ""}
    assert [p for p, _ in pagination.walk(pages.get, len)] == [1, 2]
    assert [p for p, _ in pagination.walk(lambda k: "x" * k, len, 4, "xxx")] == [1, 2]
    assert pagination.fixpoint(lambda k: min(k, 3)) == (3, 4)
    rows = spark.createDataFrame([("var totalpagina = 7;",), ("none",)], "h string").select(pagination.total_in_script(F.col("h")).alias("n"))
    assert [r.n for r in rows.collect()] == [7, 1]
    none = spark.createDataFrame([(0,)], "n int")
    assert pagination.offsets(none, F.col("n")).count() == 0 and pagination.numbered(none, F.col("n")).count() == 0


def test_json_load(spark, tmp_path):
    p = tmp_path / "a.json"
    p.write_text(json.dumps([{"id": "A-1", "precio": 5}, {}]))
    assert [(r.id, r.precio, r.barrio) for r in files.load_json(spark, str(p)).orderBy("id").collect()] == [("", 0, ""), ("A-1", 5, "")]
    for text in ("{}", "", " \n", '"["'):
        p.write_text(text)
        with pytest.raises(ValueError, match="array"):
            files.load_json(spark, str(p))
    p.write_text("\ufeff \n" + json.dumps([{"id": "A-2"}]))
    assert files.load_json(spark, str(p)).first().id == "A-2"
    p.write_text('{"id": "A-1", "precio": 5}\n{"id": null}\n')
    assert sorted((r.id, r.precio) for r in files.load_json(spark, str(p), lines=True).collect()) == [("", 0), ("A-1", 5)]
    p.write_text('{"id": "A-1"}\nbad\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        files.load_json(spark, str(p), lines=True).collect()


def test_csv(spark, tmp_path):
    row = ("A-1", "p", "casa", 5, 0, 1, 2, 3, 4, 'El "Sol", x', "null")
    path = files.write_csv(spark.createDataFrame([row], LISTING), str(tmp_path), "p")
    raw = open(path, "rb").read()
    assert raw.startswith(b"\xef\xbb\xbfid,portal") and raw.count(b"\r\n") == 2
    assert raw.split(b"\r\n")[1].decode() == '"A-1","p","casa",5,0,1,2,3,4,"El ""Sol"", x",""'
    assert list(csv.reader(open(path, encoding="utf-8-sig")))[1][9] == 'El "Sol", x'


def test_csv_parts(spark, tmp_path):
    rows = [(f"A-{k}", "p", "casa", k, 0, 1, 2, 3, 4, "x", "u") for k in range(50)]
    table = spark.createDataFrame(rows, LISTING)
    files.write_csv_parts(table.repartitionByRange(4, "precio").sortWithinPartitions("precio"), str(tmp_path / "parts"))
    one = open(files.write_csv(table, str(tmp_path), "p"), "rb").read()
    parts = [f.read_bytes() for folder in ("parts-header", "parts") for f in sorted((tmp_path / folder).glob("part-*"))]
    assert b"".join(parts) == one and len(parts) > 3


def test_inline_pages():
    assert fetch.inline("data:text/html;base64,w6E8Yj4=") == (200, "á<b>") and fetch.inline("data:,a%20b") == (200, "a b") and fetch.inline("https://x/,y") == (404, "")


def test_stream(spark, tmp_path):
    store = ListingStore(spark, str(tmp_path / "t"))
    base = "'p' AS portal, '' AS tipo, 1L AS precio, 0 AS area, 0 AS habitaciones, 0 AS banos, 0 AS parqueaderos, 0 AS estrato, '' AS barrio, '' AS url, 'm' AS ciudad, 'active' AS status, timestamp'2024-01-01' AS scraped_at"
    for ids in (("A", "B"), ("B", "C")):
        spark.sql(" UNION ALL ".join(f"SELECT '{k}' AS id, {base}" for k in ids)).select(*STORED.names).write.mode("append").parquet(str(tmp_path / "in"))
        follow(spark, str(tmp_path / "in"), store, str(tmp_path / "check")).awaitTermination()
    assert {r.id: r.status for r in store.read().collect()} == {"A": "inactive", "B": "active", "C": "active"} and store.version() == 2


def test_current_page(spark):
    pages = ["<li class='pager current x'><a>12</a></li><b class='current'>3</b>", "<li class='currently'>9</li>", "<span class=\"current\">last</span>", None]
    rows = spark.createDataFrame([(k, p) for k, p in enumerate(pages)], "k int, html string")
    assert [r.n for r in rows.select("k", pagination.current_page(F.col("html")).alias("n")).orderBy("k").collect()] == [12, 1, 1, 1]


def test_too_many_requests_wait_longer():
    waits = []
    assert fetch.fetch_page("u", Replies((429, ""), (429, ""), (200, "ok")), waits.append) == "ok" and waits == [5, 10]
    waits.clear()
    assert fetch.fetch_page("u", Replies(*[(429, "")] * 4), waits.append) is None and waits == [5, 10, 20]


def test_batches_wait_while_the_server_is_busy():
    urls, refused, waits, asked = [f"u{k}" for k in range(60)], {"u3", "u30"}, [], []

    def transport(url):
        asked.append(url)
        if url in refused:
            refused.discard(url)
            return 429, ""
        return (404, "") if url == "u7" else (200, f"<{url}>")

    found = list(fetch.fetch_batches(urls, transport, waits.append))
    assert found == [(u, None if u == "u7" else f"<{u}>") for u in urls]
    assert waits == [5, 5, 10, 10] and len(asked) == 62 and set(asked[:25]) == set(urls[:25]) and asked[25] == "u3"
    assert list(fetch.fetch_batches(["a"], lambda u: (429, ""), waits.append)) == [("a", None)]
    assert list(fetch.fetch_batches([], transport)) == []


def test_until_empty_of_many_sources(spark):
    rows = [("a", 1, 5), ("a", 2, 0), ("a", 3, 5), ("b", 1, 2), (None, 1, 1), (None, 2, 0), ("c", 1, 0)]
    kept = pagination.until_empty(spark.createDataFrame(rows, "source string, page int, cards int"), ["source"])
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted([("a", 1, 5), ("b", 1, 2), (None, 1, 1)], key=repr)


def test_an_action_that_never_settles_is_told():
    assert pagination.fixpoint([1, 2, 2].__getitem__) == (2, 2)
    with pytest.raises(RuntimeError):
        pagination.fixpoint(lambda k: k, 5)
