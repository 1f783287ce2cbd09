"""Registered queries over the driver tables, with their checking SQL."""

from __future__ import annotations

from tickerloom.catalog import alpha, chat, dates, flows, labels, rows, sources, text

_MODULES = (alpha, text, labels, dates, rows, chat, flows, sources)


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for module in _MODULES:
        entries = getattr(module, attribute)
        clash = merged.keys() & entries.keys()
        if clash:
            raise ValueError(f"query registered twice: {sorted(clash)}")
        merged.update(entries)
    return merged


def all_queries() -> dict:
    return _merged("QUERIES")


def all_oracles() -> dict:
    return _merged("ORACLES")
