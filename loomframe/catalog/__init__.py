"""All registered queries."""

from importlib import import_module

MODULES = ("projections", "splits", "scalers", "texts", "series", "graphs", "metrics", "neighbors", "models")


def _load():
    for name in MODULES:
        import_module(f"loomframe.catalog.{name}")
    from loomframe.catalog import registry

    return registry


def all_queries():
    return _load().QUERIES


def all_oracles():
    return _load().ORACLES
