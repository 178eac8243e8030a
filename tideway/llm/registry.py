"""The queries of this package: name → function (spark, sf_dir) and, where SQL can say the same, the SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tideway.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(tune(spark), sf_dir)

        run.__doc__ = f.__doc__
        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLES[f.__name__] = sql.strip()
        return run

    return register
