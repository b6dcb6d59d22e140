"""Where queries are registered."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add
