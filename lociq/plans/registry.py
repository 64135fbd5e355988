"""Where query modules register: a query under its name, with its DuckDB equivalent if there is one."""

from __future__ import annotations

from lociq.sources.proxies import with_views

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        if name in QUERIES:
            raise ValueError(name)
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = with_views(sql)
        return f

    return register
