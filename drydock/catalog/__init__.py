"""Every registered query with its SQL oracle."""

from __future__ import annotations

from pyspark.sql import SparkSession

from drydock.session import ship_package


def _modules():
    from drydock.catalog import dictionaries, intake, profiles, shaping
    return (profiles, shaping, intake, dictionaries)


def queries() -> dict:
    found: dict = {}
    for module in _modules():
        for name, query in module.QUERIES.items():
            found[name] = _shipped(query)
    return found


def oracle_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    for module in _modules():
        found.update(module.ORACLES)
    return found


def _shipped(query):
    def run(spark: SparkSession, sf_dir: str):
        ship_package(spark)
        return query(spark, sf_dir)
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run
