"""Where the queries of this subpackage are registered; ``load()`` imports the modules that do so."""

from __future__ import annotations

import importlib

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
MODULES = ["knn", "quality", "warc", "passages", "minhash", "packing", "lines", "secrets", "urlrules", "decontaminate", "merkle", "resample", "sentencepieces"]


def query(name: str, oracle: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"scarmap.llm.{name}")
