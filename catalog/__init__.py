"""Registered queries over the test tables, each with its SQL counterpart."""

from catalog import align, climate, observations, series, space, stores, weekly

_PARTS = (climate, space, align, observations, series, stores, weekly)


def all_queries() -> dict:
    return {name: fn for part in _PARTS for name, (fn, _) in part.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS
            for name, (_, sql) in part.QUERIES.items() if sql is not None}
