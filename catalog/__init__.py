"""Every implemented operator as a query over the driver tables, with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load() -> None:
    from catalog import (  # noqa: F401
        aggregates,
        composed,
        filters,
        joins,
        ordered,
        rules,
        scalars,
        scans,
        streams,
    )
