"""Bounded JDBC source."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _literal(value) -> str:
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    return str(value)


def equi_depth_predicates(keys: DataFrame, column: str, splits: int, accuracy: int = 10000) -> list[str]:
    """S4 split planner: WHERE clauses that cut a table into ranges of about equal numbers of rows.

    The bounds come from one quantile sketch of ``column`` (numbers, dates, timestamps), so skewed keys
    give ranges of equal depth where equal strides would give one range nearly all rows.  Every row is in
    exactly one range; nulls have a range of their own.  ``accuracy`` bounds the error of a quantile at
    rows / accuracy and with ``splits`` the size of what reaches the driver.  A single value that holds more
    than a split's share makes one larger range: ranges cannot divide it.  A column without values gives
    the range of nulls alone.
    """
    if splits < 1:
        raise ValueError("splits must be positive")
    shares = [i / splits for i in range(1, splits)]
    found = keys.agg(F.min(column), F.percentile_approx(column, shares, accuracy) if shares else F.lit(None)).first()
    if found[0] is None:
        return [f"{column} IS NULL"]
    bounds = [_literal(b) for b in sorted(set(found[1] or []))]
    if not bounds:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    return [f"{column} <= {bounds[0]}", *[f"{column} > {a} AND {column} <= {b}" for a, b in zip(bounds, bounds[1:])],
            f"{column} > {bounds[-1]}", f"{column} IS NULL"]


def read_jdbc_planned(spark: SparkSession, url: str, table: str, column: str, splits: int, *,
                      fetchsize: int = 10000, properties: dict | None = None) -> DataFrame:
    """S4 with ranges of equal depth: one pass over the key column plans them, one task reads each."""
    keys = read_jdbc(spark, url, query=f"SELECT {column} FROM {table}", fetchsize=fetchsize, properties=properties)
    options = {**(properties or {}), "fetchsize": str(fetchsize)}
    return spark.read.jdbc(url, table, predicates=equi_depth_predicates(keys, column, splits), properties=options)


def read_jdbc(spark: SparkSession, url: str, *, query: str | None = None,
              table: str | None = None, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None, fetchsize: int = 10000,
              properties: dict | None = None) -> DataFrame:
    """Read a table or query over JDBC.

    A ``query`` is one split (one task), as in the reference.  At scale pass
    ``table`` with ``partition_column`` and bounds so Spark issues
    ``num_partitions`` range queries in parallel (Spark forbids combining
    them with ``query``).  Filters and projections on the result are pushed
    into the generated SQL.
    """
    if (query is None) == (table is None):
        raise ValueError("give exactly one of query= or table=")
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", fetchsize)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if query is not None:
        if partition_column:
            raise ValueError("partitioned reads need table=, not query=")
        return r.option("query", query).load()
    r = r.option("dbtable", table)
    if partition_column:
        r = (r.option("partitionColumn", partition_column)
             .option("lowerBound", lower_bound).option("upperBound", upper_bound)
             .option("numPartitions", num_partitions or 8))
    return r.load()
