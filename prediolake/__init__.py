"""A Spark-native engine for collections of property listings."""

from importlib import import_module

#: Public names and where they live; each module is imported when its name is first used.
_PUBLIC = {
    "fetch_page": "sources.fetch",
    "fetch_json": "sources.fetch",
    "bulk_fetch": "sources.fetch",
    "normalize_price": "functions.normalize:price",
    "normalize_tipo": "functions.normalize:tipo",
    "normalize_estrato": "functions.normalize:estrato",
    "normalize_garaje": "functions.normalize:garaje",
    "normalize_barrio": "functions.normalize:barrio",
    "normalize_url": "functions.normalize:url",
    "TIPO": "fixed",
    "validate": "functions.validate:corrected",
    "write_csv": "sources.files",
    "ListingStore": "sources.store",
    "parser": "plans.orchestrate",
    "main": "plans.orchestrate",
    "scrape": "plans.portals",
    "collect": "plans.portals",
    "get_all": "sources.catalog",
    "create_table": "sources.catalog:create",
    "insert_listings": "operators.lifecycle:upsert",
    "deactivate": "operators.lifecycle",
    "health_check": "plans.orchestrate",
    "run_all": "plans.orchestrate",
}
__all__ = list(_PUBLIC)


def __getattr__(name: str):
    if name not in _PUBLIC:
        raise AttributeError(name)
    module, _, attribute = _PUBLIC[name].partition(":")
    return getattr(import_module(f".{module}", __name__), attribute or name)
