"""Queries over the given tables, one per capability, each with the SQL that states the same result."""

from . import changes, encoding, feed, reads, streams

MODULES = (reads, changes, encoding, feed, streams)


def queries() -> dict:
    return {name: fn for m in MODULES for name, (fn, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql}
