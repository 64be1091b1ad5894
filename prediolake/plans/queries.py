"""Every named query with, where SQL can express it, the SQL that checks it."""

from __future__ import annotations

from . import detection, extraction, listings, scalars, sites, timeline

QUERIES = {**listings.QUERIES, **scalars.QUERIES, **extraction.QUERIES, **detection.QUERIES, **timeline.QUERIES, **sites.QUERIES}
ORACLES = {**listings.ORACLES, **scalars.ORACLES, **extraction.ORACLES, **detection.ORACLES, **timeline.ORACLES, **sites.ORACLES}
