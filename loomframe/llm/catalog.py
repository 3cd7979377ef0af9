"""Registered queries: every operator over its whole table, with production parameters."""

from __future__ import annotations

from importlib import import_module

MODULES = ("audits", "chats", "credentials", "duplicates", "languages", "leaks", "licenses", "mixes", "neighbours", "pages", "spellings", "tokens", "toxic")


def load():
    for name in MODULES:
        import_module(f"loomframe.llm.queries.{name}")
    from loomframe.llm import registry

    return registry


def all_queries() -> dict:
    return dict(load().QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(load().ORACLES)
