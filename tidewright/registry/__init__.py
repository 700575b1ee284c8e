"""Registered queries: each is a Spark function and, where SQL can say it, its check in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from ..session import spread, tune


@dataclass(frozen=True)
class Entry:
    build: Callable[["Tables"], DataFrame]
    sql: str | None


class Tables:
    """The input tables of one scale factor; ``t.events`` reads ``events.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}.parquet"

    def wide(self, name: str, key: str) -> DataFrame:
        """A table for costly row work, spread over the cores when it has too few files for them."""
        return spread(getattr(self, name), key)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


REGISTRY: dict[str, Entry] = {}
MODULES = ("funnel", "scalars", "monitoring", "vectors", "texts", "clusters", "loading", "live")


def register(name: str, sql: str | None = None):
    def add(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Entry(fn, sql)
        return fn

    return add


def load_all() -> dict[str, Entry]:
    for module in MODULES:
        import_module(f"{__name__}.{module}")
    return REGISTRY
