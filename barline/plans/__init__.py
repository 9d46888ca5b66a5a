"""The registered queries: each is a Spark function and the SQL that must give the same rows."""

from __future__ import annotations

QUERIES = {}
SQL = {}


def query(sql: str | None = None):
    """Registers a function of (spark, folder) under its own name, with its SQL where there is one."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def load_all():
    from barline.plans import backfill, files, ingest, market, strategy, symbols  # noqa: F401

    return QUERIES, SQL
