"""Registry of the proof queries: each Spark query beside its SQL oracle.

A query is a function ``(spark, sf_dir) -> DataFrame`` over the driver
tables (or data Spark derives from them). Its oracle is ANSI SQL that DuckDB
runs on the same tables; column names match one to one. Queries whose
semantics SQL cannot state register ``sql=None`` and are checked against a
brute-force fixture in ``tests/`` instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import apply_engine_conf, read_table

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    name: str
    fn: QueryFn
    sql: str | None
    operators: tuple[str, ...]


REGISTRY: dict[str, Registered] = {}


def query(name: str, operators: str, sql: str | None):
    """Decorator: register ``fn`` under ``name`` with its oracle SQL and the
    SURVEY operator ids it proves (space separated)."""
    def wrap(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_engine_conf(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = Registered(name, run, sql.strip() if sql else None, tuple(operators.split()))
        return run
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def load_all() -> dict[str, Registered]:
    """Import every query module (registration happens on import)."""
    from . import (  # noqa: F401
        q_dictionary,
        q_entities,
        q_files,
        q_links,
        q_nested,
        q_paths,
        q_proofs,
        q_relational,
        q_reshape,
        q_scalars,
        q_sinks,
    )
    return REGISTRY
