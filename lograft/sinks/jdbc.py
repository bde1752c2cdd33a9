"""K2: JDBC insert sink (column subset; the key is left to the database)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, url: str, table: str, columns: list[str] | None = None,
               batchsize: int = 1000, num_partitions: int | None = None,
               properties: dict | None = None) -> None:
    """``INSERT INTO table(columns) VALUES(...)`` in batches of ``batchsize``.

    Appending a column subset leaves an auto-increment key to the database.
    ``num_partitions`` caps concurrent connections.  Task retries re-send a
    partition (at-least-once); use a unique key downstream or write via a
    staging table for exactly-once.
    """
    out = df.select(*columns) if columns else df
    w = (out.write.format("jdbc").mode("append").option("url", url)
         .option("dbtable", table).option("batchsize", batchsize))
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()

