"""Query registry: name -> (Spark plan builder, DuckDB oracle text or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    fn: QueryFn
    oracle: str | None
    headline: bool = False


REGISTRY: dict[str, Entry] = {}


def query(name: str, oracle: str | None = None, headline: bool = False):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = Entry(name, run, oracle, headline)
        return run

    return deco
