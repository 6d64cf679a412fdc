"""The registered queries: a callable each, and its SQL twin where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingspark.session import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, so that results compare across engines."""
    dated = [n for n, t in df.dtypes if t in ("date", "timestamp", "timestamp_ntz")]
    return df.withColumns({c: F.col(c).cast("string") for c in dated}) if dated else df


def query(name: str, sql: str | None = None) -> Callable[[Callable], Callable]:
    """Register a function of ``(tables)`` under ``name``."""
    from filingspark.plans.proxies import Tables

    def register(build: Callable[[Tables], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")  # dates as text are UTC, as in the SQL twins
            ship(spark)
            return plain(build(Tables(spark, sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register
