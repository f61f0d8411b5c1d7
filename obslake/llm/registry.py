"""Registration of the subpackage's queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from obslake.catalog.registry import Query, Tables

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Callable], Query]:
    """Register a function of the tables under its own name, with its SQL if it has one."""

    def register(build: Callable) -> Query:
        def run(spark, folder):
            return build(Tables(spark, folder))

        run.__name__, run.__doc__ = build.__name__, build.__doc__
        _queries[build.__name__] = run
        if sql is not None:
            _oracles[build.__name__] = sql
        return run

    return register


def registered() -> dict[str, Query]:
    return dict(_queries)


def oracles() -> dict[str, str]:
    return dict(_oracles)
