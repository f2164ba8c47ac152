"""Every operator as a query over the driver's tables, with the same question in SQL for a second engine."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None
    covers: str


class Catalog(dict):
    def add(self, name: str, covers: str, run: Run, sql: str | None = None) -> None:
        if name in self:
            raise ValueError(f"query {name} is registered twice")
        self[name] = Query(run, sql, covers)


def all_queries() -> Catalog:
    from docfields.catalog import events, extraction, jobs, requests, streams, texts

    merged = Catalog()
    for module in (extraction, texts, requests, jobs, events, streams):
        for name, query in module.QUERIES.items():
            merged.add(name, query.covers, query.run, query.sql)
    return merged
