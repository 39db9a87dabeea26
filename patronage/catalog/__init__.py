"""Named queries over the test tables, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from patronage.catalog import analyses, blocks, checks, oracle_analyses, oracle_blocks, oracle_checks
from patronage.catalog.present import plain
from patronage.sources.binding import BoundTables

_QUERIES = {**analyses.QUERIES, **checks.QUERIES, **blocks.QUERIES}
_ORACLE = {**oracle_analyses.ORACLE, **oracle_checks.ORACLE, **oracle_blocks.ORACLE}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, folder: plain(build(BoundTables(spark, folder)))

    return {name: bind(build) for name, build in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: _ORACLE[name].strip() for name in _QUERIES if name in _ORACLE}
