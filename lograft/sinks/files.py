"""K5 CSV file sink and K1 broker sink (with a file stand-in)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "append") -> None:
    """K5: header-less CSV (DECIMAL written as plain text)."""
    df.write.mode(mode).option("sep", sep).option("header", "false").csv(path)


def to_value_frame(df: DataFrame, value_col: str, partitions: int | None = None) -> DataFrame:
    """One ``value`` column, redistributed to the sink parallelism.

    ``repartition`` (round-robin) like the reference's rebalance between
    source and sink; a ``coalesce`` would be narrow and run the upstream
    parsing in only ``partitions`` tasks."""
    out = df.selectExpr(f"CAST({value_col} AS STRING) AS value")
    return out.repartition(partitions) if partitions else out
