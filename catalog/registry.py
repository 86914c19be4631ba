"""Registry of queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from tripledger.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Result types that compare the same in any engine: dates and times as ISO text, decimals as double."""

    def plain(field):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DateType):
            return c.cast("string").alias(field.name)
        if isinstance(field.dataType, (TimestampNTZType, TimestampType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        if isinstance(field.dataType, DecimalType):
            return c.cast("double").alias(field.name)
        return c

    return df.select(*[plain(f) for f in df.schema.fields])


def add(name: str, run: Query, sql: str | None = None) -> None:
    assert name not in QUERIES, name
    QUERIES[name] = lambda spark, folder: portable(run(configure(spark), folder))
    if sql:
        ORACLES[name] = sql


def query(name: str, sql: str | None = None):
    """Decorator form of ``add``."""

    def wrap(run: Query) -> Query:
        add(name, run, sql)
        return run

    return wrap
