"""Registry of queries over the test tables, each with SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .tables import CTES, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, tuple[str, ...]] = {}


def with_ctes(sql: str) -> str:
    """Prefix a statement with the named tables it uses, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    tables = ",\n".join(f"{n} AS ({CTES[n]})" for n in needed)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {tables},\n{body[5:]}"
    return f"WITH {tables}\n{body}"


def query(name: str, covers: str, sql: str | None = None, stored: bool = False):
    """Register a function of ``Tables`` under ``name``; ``covers`` lists inventory ids. With ``stored`` the shared tables of the SQL are computed once each."""
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        COVERS[name] = tuple(covers.split())
        if sql is not None:
            ORACLES[name] = re.sub(r"(?m)^(WITH )?(\w+) AS \(", r"\1\2 AS MATERIALIZED (", with_ctes(sql)) if stored else with_ctes(sql)
        return fn

    return register
