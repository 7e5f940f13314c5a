"""Query registry used by the entry point, the benchmark and the tests."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from workload.domain import Domain
from workload.prelude import PRELUDE


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Domain], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, prelude: bool = True):
    """Register ``build(domain)`` under a name; ``sql`` follows the shared CTE prelude.

    ``sql`` is either a plain SELECT or ``name AS (...), ... SELECT`` whose leading
    CTEs extend the prelude.
    """

    def register(build: Callable[[Domain], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        text = None
        if sql is not None:
            body = sql.strip()
            if prelude:
                joiner = "\n" if body[:6].upper() == "SELECT" else ",\n"
                text = PRELUDE + joiner + body
            else:
                text = body
        QUERIES[name] = Query(name, build, text)
        return build

    return register


_DOMAINS: dict[tuple[str, str], Domain] = {}


def domain(spark: SparkSession, sf_dir: str) -> Domain:
    """One lazily built domain per session and directory; its stored hand-off tables are shared, too."""
    key = (spark.sparkContext.applicationId, str(sf_dir))
    if key not in _DOMAINS:
        _DOMAINS[key] = Domain(spark, str(sf_dir))
    return _DOMAINS[key]


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES[name].build(domain(spark, sf_dir))


def half_up(n: str, d: str, scale: int = 6) -> str:
    """SQL text of n/d rounded half up with integer arithmetic, as DOUBLE."""
    p = 10**scale
    return (
        f"(CASE WHEN ({d}) = 0 THEN NULL ELSE "
        f"((({n})::HUGEINT * {2 * p} + ({d})) // (2 * ({d})))::DOUBLE / {p} END)"
    )
