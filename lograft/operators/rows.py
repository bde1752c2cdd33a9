"""T10 row map with contained failure; T11 SQL projection with alias."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def age_increment(df: DataFrame, col: str = "age") -> DataFrame:
    """``age := age + 1``; a NULL or overflowing age becomes a reject.

    Adds ``reject_reason``; ``try_add`` returns NULL instead of raising on
    INT overflow (the Java code wrapped silently; rejecting is deliberate).
    """
    new = F.try_add(F.col(col), F.lit(1))
    return df.withColumn(col, new).withColumn(
        "reject_reason", F.when(F.col(col).isNull(), F.lit(f"bad:{col}")))


def project_sql(spark: SparkSession, df: DataFrame, view: str, sql: str) -> DataFrame:
    """Run a SQL text against ``df`` registered as ``view``."""
    df.createOrReplaceTempView(view)
    return spark.sql(sql)


# Fixed value: the one SQL text the reference hands to its planner.
CSV_PROJECT_SQL = "SELECT e AS sum_e FROM test_table"
