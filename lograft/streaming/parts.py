"""Ordinary partitioned tables that streams keep, and marks of what a batch has done.

``PartTable`` is a parquet table partitioned by days or key buckets.  A batch brings
reduced rows; the partitions that they touch are read, merged with them and staged
as a whole, and then replace the old ones (dynamic partition overwrite).  A replayed
batch finds its staged partitions and writes the same contents again, so nothing is
added twice; a batch that stopped before it had staged everything has not changed the
table.  Partitions that a batch does not touch are neither read nor written.  While
partitions are being replaced a reader may miss one; the staged copy is kept until
the batch after the next.

``foreachBatch`` repeats a stream's last batch only, so marks and staged copies have
two slots and never grow in number.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

BUCKETS = 64
PART = "table_part"


def read_if_there(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Parquet files under ``path``; no rows if the folder was never written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class Mark:
    """Says that a step of a batch is complete, with a short note."""

    path: str

    def _slot(self, batch_id: int) -> str:
        return f"{self.path}/slot={batch_id % 2}"

    def set(self, spark: SparkSession, batch_id: int, note: str = "") -> None:
        spark.createDataFrame([(batch_id, note)], "batch_id BIGINT, note STRING").coalesce(1) \
            .write.mode("overwrite").parquet(self._slot(batch_id))

    def _rows(self, spark: SparkSession, slot: int) -> list:
        return read_if_there(spark, self._slot(slot), "batch_id BIGINT, note STRING").collect()

    def holds(self, spark: SparkSession, batch_id: int) -> bool:
        return any(r.batch_id == batch_id for r in self._rows(spark, batch_id))

    def newest(self, spark: SparkSession):
        """The row set last, or None."""
        return max(self._rows(spark, 0) + self._rows(spark, 1), default=None, key=lambda r: r.batch_id)


def day_part(column: str = "day") -> str:
    return f"coalesce(cast(to_date({column}) AS string), 'none')"


def bucket_part(keys: list[str], buckets: int = BUCKETS) -> str:
    return f"cast(pmod(xxhash64({', '.join(keys)}), {int(buckets)}) AS string)"


def _with_part(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(PART, StringType())])


@dataclass(frozen=True)
class PartTable:
    """``merge`` brings several states of a key to one, in any order; ``part`` is a SQL expression over
    the table's columns that is equal for all rows of a key."""

    root: str
    merge: Callable[[DataFrame], DataFrame]
    part: str

    def _mark(self) -> Mark:
        return Mark(f"{self.root}_staged/mark")

    def _stored(self, spark: SparkSession, schema: StructType) -> DataFrame:
        return read_if_there(spark, self.root, _with_part(schema))

    def apply(self, rows: DataFrame, batch_id: int) -> None:
        """Merge a batch's rows into the table; again with the same ``batch_id`` it changes nothing."""
        spark, mark = rows.sparkSession, self._mark()
        slot = f"{self.root}_staged/slot={batch_id % 2}"
        if not mark.holds(spark, batch_id):
            new = rows.withColumn(PART, F.expr(self.part)).persist()
            try:
                touched = [r[0] for r in new.select(PART).distinct().collect()]  # days or buckets
                stored = self._stored(spark, rows.schema).where(F.col(PART).isin(touched))
                merged = self.merge(stored.unionByName(new).drop(PART))
                merged.withColumn(PART, F.expr(self.part)).write.mode("overwrite").partitionBy(PART).parquet(slot)
            finally:
                new.unpersist()
            mark.set(spark, batch_id, rows.schema.json())
        staged = read_if_there(spark, slot, _with_part(rows.schema))
        (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(self.root))

    def read(self, spark: SparkSession) -> DataFrame:
        import json
        newest = self._mark().newest(spark)
        if newest is None:
            raise FileNotFoundError(f"no batch was written to {self.root}")
        return self._stored(spark, StructType.fromJson(json.loads(newest.note))).drop(PART)

    def parts(self, spark: SparkSession) -> list[str]:
        """The partitions that hold rows, from the folders' names."""
        newest = self._mark().newest(spark)
        if newest is None:
            return []
        stored = read_if_there(spark, self.root, _with_part(StructType()))
        return sorted(r[0] for r in stored.select(PART).distinct().collect())

    def drop_before(self, spark: SparkSession, oldest: str) -> None:
        """Partitions below ``oldest`` leave the table (M3)."""
        from lograft.session import remove_folder
        for part in self.parts(spark):
            if part < oldest:
                remove_folder(f"{self.root}/{PART}={part}")
