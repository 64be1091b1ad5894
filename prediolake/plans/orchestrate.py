"""Runs over portals: health, backup, scrape, validation, report; and the command line."""

from __future__ import annotations

import argparse
import sys
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager, nullcontext
from datetime import datetime
from pathlib import PurePosixPath
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..functions import validate
from ..operators import lifecycle
from ..sources import files, scratch
from ..sources.store import ListingStore
from .listings import exportable
from .portals import REGISTRY, scrape
from .report import box

#: portal -> (pages, details or None)
Pages = Callable[[str], tuple[DataFrame, DataFrame | None]]
LEAST = {p: least for p, _, least, _ in fixed.PORTALS}
#: Short names of portals.
ALIASES = {script: p for p, _, _, script in fixed.PORTALS if script}


def stored(listings: DataFrame, ciudad: str, at: datetime) -> DataFrame:
    """Listings as the table has them, with their city: without it a scope would never match."""
    return listings.withColumns({"ciudad": F.lit(ciudad.strip().lower()), "status": F.lit("active"), "scraped_at": F.lit(at).cast("timestamp")})


def run_portal(portal: str, pages: Pages, store: ListingStore | None, csv_folder: str | None, ciudad: str = "medellin", sample_only: bool = False, max_pages: int | None = None, at: datetime | None = None, turn: AbstractContextManager | None = None) -> dict:
    """Scrape one portal and write it; a failure is raised, not counted as a success. Nothing found: code 2; a sample isn't written. turn: held while the table is written."""
    began = time.time()
    listings = scrape(portal, *pages(portal), sample_only, max_pages).persist()
    try:
        counts = listings.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("warnings")), F.lit(0)).alias("w")).first()
        if counts["n"] and not sample_only:
            if csv_folder:
                files.write_csv(listings, csv_folder, portal, ciudad)
            if store:
                with turn or nullcontext():
                    store.commit(lambda table: lifecycle.refresh(table, stored(listings, ciudad, at or datetime.now()), ["seq"]))
    finally:
        listings.unpersist()
    return {"portal": portal, "code": 0 if counts["n"] else 2, "listings": counts["n"], "warnings": counts["w"], "elapsed": time.time() - began}


def _tried(portal: str, key: str, run: Callable[[], dict]) -> dict:
    began = time.time()
    try:
        r = run()
        return {"portal": portal, key: r["code"] == 0, "listings": r["listings"], "elapsed": time.time() - began, "error": None if r["code"] == 0 else "0 listings"}
    except Exception as e:  # one portal's failure is its result; the others go on
        return {"portal": portal, key: False, "listings": 0, "elapsed": time.time() - began, "error": str(e)[:200]}


def health_check(portals: Sequence[str], pages: Pages, ciudad: str = "medellin") -> list[dict]:
    """A sample of every portal at once."""
    with ThreadPoolExecutor(max(1, len(portals))) as pool:
        return sorted(pool.map(lambda p: _tried(p, "healthy", lambda: run_portal(p, pages, None, None, ciudad, True)), portals), key=lambda r: r["portal"])


def scrape_all(portals: Sequence[str], pages: Pages, store: ListingStore, ciudad: str = "medellin", workers: int = 4) -> list[dict]:
    """The portals' listings, scraped ``workers`` at a time; only their versions are committed one after another."""
    turn = Lock()

    def one(p: str) -> dict:
        return _tried(p, "success", lambda: run_portal(p, pages, store, None, ciudad, turn=turn))

    with ThreadPoolExecutor(workers) as pool:
        return sorted(pool.map(one, portals), key=lambda r: r["portal"])


def verdict(results: list[dict], asked: Sequence[str]) -> tuple[bool, list[str]]:
    """Whether every portal asked for gave its least number of listings, and what is wrong. One that was not scraped at all is wrong, too."""
    by = {r["portal"]: r for r in results}
    warnings = []
    for p in asked:
        r = by.get(p)
        if r is None or not r["success"]:
            warnings.append(f"{p}: FAILED — {(r or {}).get('error') or 'unknown error'}")
        elif r["listings"] < LEAST.get(p, 0):
            warnings.append(f"{p}: {r['listings']} listings (min {LEAST[p]})")
    return not warnings, warnings


def run_all(spark: SparkSession, pages: Pages, store: ListingStore, portals: Sequence[str] | None = None, ciudad: str = "medellin", workers: int = 4, skip_health: bool = False, backup_folder: str | None = None, now: datetime | None = None) -> tuple[int, str]:
    """(exit code, report): health, backup, the healthy portals' scrape, validation of all."""
    began, now = time.time(), now or datetime.now()
    asked = list(portals or REGISTRY)
    health = [] if skip_health else health_check(asked, pages, ciudad)
    backup = store.backup(backup_folder, now.strftime("%Y%m%d_%H%M%S")) if backup_folder else None
    scraped = scrape_all([p for p in asked if skip_health or any(r["portal"] == p and r["healthy"] for r in health)], pages, store, ciudad, workers)
    passed, warnings = verdict(scraped, asked)
    return (0 if passed else 1), box(health, scraped, passed, warnings, backup, time.time() - began, now)


def load_file(spark: SparkSession, path: str, ciudad: str, store: ListingStore, at: datetime | None = None) -> dict:
    """A JSON file's listings, repaired, into the table: counts of rows, new, refreshed, flagged and delisted."""
    return load_rows(numbered(spark, path), ciudad, store, at)


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """A JSON file's listings, repaired, with their place in it: saved once, so that every count and the preview see the same numbers and the file is read once."""
    return scratch.keep(validate.loaded(files.load_json(spark, path)).withColumn("seq", F.monotonically_increasing_id()), "loaded")


def load_rows(rows: DataFrame, ciudad: str, store: ListingStore, at: datetime | None = None) -> dict:
    """Listings with their place (seq) into the table."""
    before = store.read()
    delta = lifecycle.load_delta(before, rows).first()
    store.commit(lambda table: lifecycle.refresh(table, stored(rows, ciudad, at or datetime.now()), ["seq"]))
    scope = rows.agg(F.min_by("portal", "seq")).first()[0]
    gone = store.read().filter((F.col("portal") == (scope or "")) & (F.col("ciudad") == ciudad.strip().lower()) & (F.col("status") == "inactive")).count()
    return {"rows": delta["batch_rows"], "new": delta["new_rows"], "refreshed": delta["refreshed"], "flagged": rows.filter(F.size("issues") > 0).count(), "inactive": gone}


def preview(rows: DataFrame, flagged: int = 5, ends: int = 3) -> str:
    """What a load shows of its rows: the first flagged ones with their issues, and the first and last of all."""
    def line(r) -> str:
        return f"  {r['id']} | {r['tipo']} | {r['precio']} | {r['barrio']}"

    held = rows.select("seq", "id", "tipo", "precio", "barrio", "issues")
    bad = held.filter(F.size("issues") > 0).orderBy("seq").limit(flagged).collect()
    first, last = held.orderBy("seq").limit(ends).collect(), held.orderBy(F.desc("seq")).limit(ends).collect()[::-1]
    return "\n".join(["Flagged:", *(f"{line(r)} | {', '.join(r['issues'])}" for r in bad), "First:", *map(line, first), "Last:", *map(line, last)])


def export(table: DataFrame, city: str | None = None, portal: str | None = None) -> DataFrame:
    """Exportable rows of a city and a portal, whatever their case, newest first, as a sheet takes them."""
    rows = exportable(table)
    for column, value in (("ciudad", city), ("portal", portal)):
        if value:
            rows = rows.filter(F.lower(column) == value.lower())
    return files.export_values(rows.orderBy(F.desc("scraped_at"), "id"))


def export_sheet(table: DataFrame, target: str, city: str | None = None, portal: str | None = None, title: str | None = None, new: bool = False, now: datetime | None = None) -> int:
    """Rewrite the sheet in the target folder with the exportable rows, or with ``new``, or where the target has none, make one under a title. Nothing to export: a message, and nothing is written. The exit code.

    A sheet is a folder of Parquet; the title (by default that of the time) is a folder below the target for a new one.
    """
    rows = scratch.keep(export(table, city, portal), "export")
    found = rows.count()
    if not found:
        print("No listings found in the database.")
        return 0
    print(f"Exporting {found} listings...")
    name = title or f"Rental Listings Export - {(now or datetime.now()).strftime('%Y-%m-%d %H:%M:%S')}"
    path = f"{target.rstrip('/')}/{name}" if new else target
    rows.write.mode("errorifexists" if new else "overwrite").parquet(path)
    print(f"Done! {'Sheet' if new else 'Sheet updated'}: {path}")
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="prediolake")
    p.add_argument("--store", required=True, help="folder of the listings table")
    commands = p.add_subparsers(dest="command", required=True)
    one = commands.add_parser("scrape")
    one.add_argument("portal", type=lambda name: ALIASES.get(name, name), choices=sorted(REGISTRY), help="a portal, or its short name")
    one.add_argument("--pages", required=True, help="Parquet of (pos, url, html)")
    one.add_argument("--details", help="Parquet of (pos, url, html)")
    one.add_argument("--output", choices=("csv", "db", "both"), default="both")
    one.add_argument("--ciudad", default="medellin")
    one.add_argument("--sample-only", action="store_true")
    one.add_argument("--max-pages", type=int)
    one.add_argument("--verbose", action="store_true")
    every = commands.add_parser("run-all")
    every.add_argument("--pages", required=True, help="folder of PORTAL.parquet and, for details, PORTAL-details.parquet")
    every.add_argument("--portals", nargs="*", type=lambda name: ALIASES.get(name, name), choices=sorted(REGISTRY))
    every.add_argument("--ciudad", default="medellin")
    every.add_argument("--workers", type=int, default=4)
    every.add_argument("--skip-health", action="store_true")
    every.add_argument("--backup", help="folder for a dump of the table before the run")
    load = commands.add_parser("load")
    load.add_argument("file")
    load.add_argument("ciudad")
    out = commands.add_parser("export")
    out.add_argument("target")
    out.add_argument("--city")
    out.add_argument("--portal")
    out.add_argument("--title", help="title of a new sheet")
    out.add_argument("--new", action="store_true", help="make a new sheet below the target in place of rewriting it")
    return p


def main(spark: SparkSession, argv: Sequence[str]) -> int:
    a = parser().parse_args(argv)
    store = ListingStore(spark, a.store)
    read = lambda p: spark.read.parquet(p) if p else None
    if a.command == "run-all":
        folder = PurePosixPath(a.pages)
        pages = lambda p: (read(str(folder / f"{p}.parquet")), read(str(folder / f"{p}-details.parquet")) if REGISTRY[p].detailed else None)
        code, report = run_all(spark, pages, store, a.portals, a.ciudad, a.workers, a.skip_health, a.backup)
        print(report)
        return code
    if a.command == "scrape":
        r = run_portal(a.portal, lambda _: (read(a.pages), read(a.details)), store if a.output in ("db", "both") else None, "results" if a.output in ("csv", "both") else None, a.ciudad, a.sample_only, a.max_pages)
        print(f"{'Sample: ' if a.sample_only else 'Scraped '}{r['listings']} listings from {a.portal}", file=sys.stdout)
        if a.verbose:
            print(f"{r['warnings']} warnings, {r['elapsed']:.1f} s", file=sys.stdout)
        return r["code"]
    if a.command == "load":
        rows = numbered(spark, a.file)
        print(load_rows(rows, a.ciudad, store))
        print(preview(rows))
        return 0
    return export_sheet(store.read(), a.target, a.city, a.portal, a.title, a.new)


