"""The console report of a run, in a box of 50 columns."""

from __future__ import annotations

from datetime import datetime

from ..functions.formats import WIDTH


def duration(seconds: float) -> str:
    if seconds < 0:
        return "0s"
    if seconds < 1:
        return f"{seconds:.1f}s"
    return f"{int(seconds)}s" if seconds < 60 else "{}m {}s".format(*divmod(int(seconds), 60))


def centred(text: str) -> str:
    text = text[: WIDTH - 2]
    left = (WIDTH - len(text)) // 2
    return "║" + (" " * left + text).ljust(WIDTH) + "║"


def _result(ok: bool, portal: str, detail: str) -> str:
    label = f"{'✅' if ok else '❌'} {portal}"
    return f"║ {label}{' ' * (max(0, WIDTH - 2 - len(label) - len(detail)) + 1)}{detail}║"


def _section(title: str, empty: str, results: list[dict], key: str, bad: str, tail: str) -> list[str]:
    rule = "╠" + "═" * WIDTH + "╣"
    if not results:
        return [rule, centred(title), centred(empty)]
    return [rule, centred(title), *(_result(r[key], r["portal"], f"{r['listings']} listings    {duration(r['elapsed'])}" if r[key] else f"({r.get('error') or bad}){tail}") for r in results)]


def box(health: list[dict], scraped: list[dict], passed: bool, warnings: list[str], backup: str | None, total_time: float, now: datetime) -> str:
    """Sections on health, results, validation and totals; lists are one row a portal, so small."""
    lines = ["╔" + "═" * WIDTH + "╗", centred("SCRAPER ORCHESTRATOR REPORT"), centred(now.strftime("%Y-%m-%d %H:%M:%S"))]
    lines += _section("HEALTH CHECK", "(no portals checked)", health, "healthy", "timeout", "       -")
    lines += _section("SCRAPE RESULTS", "(no portals scraped)", scraped, "success", "failed", "")
    lines += ["╠" + "═" * WIDTH + "╣", centred(f"VALIDATION: {'PASSED' if passed else 'FAILED'}")]
    if not passed:
        lines += [centred(w) for w in warnings] or [centred("(no warnings)")]
    found, portals = sum(r["listings"] for r in scraped), len({r["portal"] for r in scraped})
    lines += ["╠" + "═" * WIDTH + "╣", centred("BACKUP: " + (backup or "SKIPPED")), centred(f"DB UPDATE: {found:,} listings across {portals} portals"), centred(f"TOTAL TIME: {duration(total_time)}"), "╚" + "═" * WIDTH + "╝"]
    return "\n".join(lines) + "\n"
