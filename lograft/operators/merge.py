"""M1-M4: table-merge semantics of the warehouse tables, as DataFrame ops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def append(df: DataFrame, path: str, partition_by: list[str] | None = None,
           fmt: str = "parquet") -> None:
    """M1: append, duplicates kept."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def latest_by_key(df: DataFrame, keys: list[str], seq_col: str) -> DataFrame:
    """For every key the row with the highest ``seq_col`` (must be unique per key).

    Written as ``max_by(struct(row), seq)``, an aggregate with a map-side
    partial step: a key holding a third of all rows is reduced inside each
    task before the exchange instead of being sorted in one task (as a
    ``row_number`` window partitioned by the key would be).
    """
    rest = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq_col)).alias("_row"))
    return agg.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def upsert_latest(current: DataFrame, batch: DataFrame, keys: list[str],
                  seq_col: str) -> DataFrame:
    """M2: unique-key table merge; a later row (higher ``seq_col``) replaces."""
    cols = list(current.columns)
    return latest_by_key(current.select(*cols).unionByName(batch.select(*cols)), keys, seq_col)


def retention_bounds(as_of, before: int = 7, after: int = 7) -> tuple[Column, Column]:
    d = F.lit(as_of).cast("date") if not isinstance(as_of, Column) else as_of.cast("date")
    return F.date_sub(d, before), F.date_add(d, after)


def retention_split(df: DataFrame, as_of, day_col: str = "day", before: int = 7,
                    after: int = 7) -> tuple[DataFrame, DataFrame]:
    """M3: keep days in ``[as_of - before, as_of + after]``; the rest rejected.

    ``day`` is the table's partition column; with literal bounds the filter
    prunes partitions when the table is read back.
    """
    lo, hi = retention_bounds(as_of, before, after)
    inside = F.col(day_col).between(lo, hi)
    return df.where(inside), df.where(~inside | F.col(day_col).isNull())


def check_constraints(df: DataFrame, not_null: list[str] | None = None,
                      max_bytes: dict[str, int] | None = None) -> DataFrame:
    """M4: add ``reject_reason`` (NULL = loadable) for NOT NULL / VARCHAR(n).

    The length unit is bytes (UTF-8), as in the target warehouse.
    """
    reasons = []
    for c in not_null or []:
        reasons.append(F.when(F.col(c).isNull(), F.lit(f"null:{c}")))
    for c, n in (max_bytes or {}).items():
        reasons.append(F.when(F.octet_length(F.col(c)) > n, F.lit(f"too_long:{c}")))
    reason = F.coalesce(*reasons) if reasons else F.lit(None).cast("string")
    return df.withColumn("reject_reason", reason)

