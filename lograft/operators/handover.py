"""Keyed hand-over, one ordered gapless sequence per shard without one task per shard."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keyed_sequence(df: DataFrame, key: str, order: list[str], partitions: int | None = None,
                   start: DataFrame | None = None, seq_col: str = "seq") -> DataFrame:
    """Number the rows of every ``key`` from 0 in ``order``, so that a sink can take each shard in sequence.

    Two passes instead of a window over a shard: the rows are range-partitioned and sorted by key and
    order, so a hot shard spreads over many tasks; each (range, key) run is counted; prefix sums over
    those counts, at most one row per range and key, say where every run begins.  The sorted ranges are
    kept in the checkpoint folder, so both passes see the same ones after a lost executor.

    ``start`` (``key``, ``seq_col``) holds the next free number of shards handed over before; without a row
    there a shard begins at 0.  ``next_sequence`` makes it for the next call.

    Null keys form a shard of their own.  Ties of ``order`` are put in the order of a hash of the row; rows
    equal in every column stay in one range.  An empty frame gives an empty result.
    """
    taken = {"_range", "_at", "_tie", "_key", "_first", "_n", "_before"} | {seq_col}
    clash = taken & set(df.columns)
    if clash:
        raise ValueError(f"columns in use: {sorted(clash)}")
    by = [F.col(key), *map(F.col, order), F.col("_tie")]
    tied = df.withColumn("_tie", F.xxhash64(*[F.col(c) for c in df.columns]))
    ranged = tied.repartitionByRange(partitions, *by) if partitions else tied.repartitionByRange(*by)
    runs = ranged.sortWithinPartitions(*by).withColumn("_range", F.spark_partition_id()) \
        .withColumn("_at", F.monotonically_increasing_id()).drop("_tie").checkpoint()
    counts = runs.groupBy("_range", F.col(key).alias("_key")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0).cast("long"))).drop("_n")
    if start is not None:
        free = start.select(F.col(key).alias("_k"), F.col(seq_col).alias("_s"))
        begins = begins.join(free, F.col("_key").eqNullSafe(F.col("_k")), "left").withColumn(
            "_before", F.col("_before") + F.coalesce("_s", F.lit(0).cast("long"))).drop("_k", "_s")
    begins = begins.withColumnRenamed("_range", "_r")
    joined = runs.join(begins, (F.col("_range") == F.col("_r")) & F.col(key).eqNullSafe(F.col("_key")))
    return joined.select(*df.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias(seq_col))


def next_sequence(numbered: DataFrame, key: str, start: DataFrame | None = None, seq_col: str = "seq") -> DataFrame:
    """The next free number of every shard: what ``keyed_sequence`` takes as ``start`` for the next rows."""
    here = numbered.select(key, (F.col(seq_col) + 1).alias(seq_col))
    both = here if start is None else here.unionByName(start.select(key, seq_col))
    return both.groupBy(key).agg(F.max(seq_col).alias(seq_col))
