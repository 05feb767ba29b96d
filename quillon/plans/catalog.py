"""Registered queries: an operator applied to the driver's tables, and its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Registers a function (Domain) -> DataFrame under its own name."""

    def add(build):
        from .domain import Domain

        QUERIES[build.__name__] = lambda spark, sf_dir: build(Domain(spark, sf_dir))
        if oracle:
            ORACLES[build.__name__] = oracle
        return build

    return add
