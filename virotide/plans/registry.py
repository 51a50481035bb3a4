"""Named queries, each with the SQL that states its result independently (or none)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from virotide.plans.derived import cte

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, inputs: tuple[str, ...] = ()):
    """Register a query; ``inputs`` are the derived inputs that its SQL names."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            body = sql.strip()
            if inputs:
                ctes = ", ".join(cte(i) for i in inputs)
                recursive = "RECURSIVE " if body.upper().startswith("WITH RECURSIVE") else ""
                if body.upper().startswith("WITH"):
                    body = f"WITH {recursive}{ctes}, {body[4:].strip().removeprefix('RECURSIVE').strip()}"
                else:
                    body = f"WITH {ctes} {body}"
            ORACLES[name] = body
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
