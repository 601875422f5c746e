"""All registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from trackloom.plans.fixtures import Views

CATALOGS = ("overlap", "profile", "tubes", "windows", "datasets", "align", "interactions", "sources")


def _entries() -> dict:
    out: dict = {}
    for part in CATALOGS:
        entries = import_module(f"trackloom.plans.catalog_{part}").QUERIES
        twice = out.keys() & entries.keys()
        if twice:
            raise ValueError(f"registered twice: {sorted(twice)}")
        out.update(entries)
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, sf_dir: build(Views(spark, sf_dir))

    return {name: bind(build) for name, (build, _sql) in _entries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_build, sql) in _entries().items() if sql is not None}
