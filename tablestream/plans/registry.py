"""Registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tablestream.session import pin_utc

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None
    covers: tuple[str, ...]


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register the decorated builder under its own name."""

    def add(build: Build) -> Build:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(pin_utc(spark), sf_dir)

        QUERIES[build.__name__] = Query(build.__name__, run, sql, tuple(covers.split()))
        return build

    return add
