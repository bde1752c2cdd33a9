"""Text classes laid out in co-located groups, and the key census over them.

Three operators compare documents through keys that very many documents may
share (shingles, anchors).  They share this layout:

* ``lay_out`` reduces the documents to one row per distinct text (*class*) and
  stores them as a table bucketed by a group number, so later passes bring
  per-group data to the texts without moving the texts again.
* ``census`` finds the keys that at least two classes hold.  Every group sends
  each key once however many of its documents hold it, so a key held by a
  third of all rows costs one entry per chunk of text, not one per document.

Texts of equal content are reduced before the shuffle (partial aggregation), so
a large group of exact copies reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Order of rows without a doc_id: after all others.
NO_ID = (1 << 63) - 1
MAX_BUCKETS = 100_000


def row_id(column: Column) -> Column:
    """doc_id as a sortable number; null sorts after every id."""
    return F.coalesce(column.cast("long"), F.lit(NO_ID))


def public_id(column: Column) -> Column:
    return F.when(column != F.lit(NO_ID), column)


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def width_of(spark: SparkSession) -> int:
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_BUCKETS)


@dataclass
class Layout:
    """classes: h (text key), id (smallest doc_id), text, g, bucketed by g."""

    classes: DataFrame
    rows: DataFrame
    width: int


def lay_out(docs: DataFrame) -> Layout:
    """One row per distinct text, stored in buckets; ``rows`` has (id, h) of every input row.

    Null texts count as empty.  Input columns other than doc_id and text are not read.
    """
    spark = docs.sparkSession
    width = width_of(spark)
    rows = docs.select(row_id(F.col("doc_id")).alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.select("id", "text", text_key(F.col("text")).alias("h"))
    # After the aggregation, shuffle partition p holds the classes with pmod(hash(h)) = p.
    # A group number that Spark hashes to bucket p makes each task write one bucket file;
    # any other numbering would give the same results from more files.
    numbers = (spark.range(int(width * (np.log(width) + 12)) + 64).select(F.col("id").cast("int").alias("g"))
               .select("g", F.pmod(F.hash("g"), F.lit(width)).alias("p"))
               .groupBy("p").agg(F.min("g").alias("g")))
    number = {r.p: r.g for r in numbers.collect()}  # at most one number per shuffle partition
    lookup = spark.createDataFrame([(p, number.get(p, p)) for p in range(width)], "p int, g int")
    classes = (rows.groupBy("h").agg(F.min("id").alias("id"), F.first("text").alias("text"))
               .withColumn("p", F.pmod(F.hash("h"), F.lit(width)))
               .join(F.broadcast(lookup), "p").drop("p"))
    name = f"lograft_texts_{uuid4().hex}"
    (classes.write.bucketBy(width, "g").option("path", scratch_path(spark, name))
     .option("compression", "zstd").saveAsTable(name))
    return Layout(spark.table(name), rows.select("id", "h"), width)


def buckets_of(keys: np.ndarray, n: int) -> np.ndarray:
    return (keys >> np.uint64(20)) % np.uint64(n)


def split_by(bucket: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, positions) for every bucket that has positions."""
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(n + 1, dtype=bucket.dtype))
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), order[edges[b]:edges[b + 1]]


def shared_in_chunk(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and which of them two or more documents of the chunk hold."""
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(keys)) - 1
    return keys[at], docs[at] != docs[last] if len(at) else np.zeros(0, dtype=bool)


_SENT = pa.schema([("bucket", pa.int32()), ("g", pa.int32()), ("keys", pa.binary()), ("shared", pa.binary())])


def _rows(found: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in schema], schema=schema)


def by_group(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    g = np.asarray(batch.column("g"))
    for value in np.unique(g):
        yield int(value), np.flatnonzero(g == value)


def census(layout: Layout, keys_of: Callable, busy_from: int) -> DataFrame:
    """(g, keys, busy): for every group, the keys of its texts that two or more classes hold.

    ``keys_of(column)`` yields (keys, document index) per chunk of a text column.
    busy marks keys that ``busy_from`` or more chunks hold.
    """
    n = 4 * layout.width

    def send(batches):
        for batch in batches:
            for g, at in by_group(batch):
                texts = batch.column("text").take(pa.array(at))
                for keys, docs in keys_of(texts):
                    keys, shared = shared_in_chunk(keys, docs)
                    found = {f.name: [] for f in _SENT}
                    for b, where in split_by(buckets_of(keys, n), n):
                        found["bucket"].append(b)
                        found["g"].append(g)
                        found["keys"].append(keys[where].tobytes())
                        found["shared"].append(shared[where].tobytes())
                    yield _rows(found, _SENT)

    out = pa.schema([("g", pa.int32()), ("keys", pa.binary()), ("busy", pa.binary())])

    def meet(table: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(table["keys"].to_pylist()), dtype=np.uint64)
        shared = np.frombuffer(b"".join(table["shared"].to_pylist()), dtype=bool)
        held = np.array([len(x) // 8 for x in table["keys"].to_pylist()])
        g = np.repeat(np.asarray(table["g"]), held)
        distinct, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
        several = count > 1
        several[inverse[shared]] = True
        found = {f.name: [] for f in out}
        take = np.flatnonzero(several[inverse])
        inverse, g = inverse[take], g[take]
        for value in np.unique(g):
            mine = np.unique(inverse[g == value])
            found["g"].append(int(value))
            found["keys"].append(distinct[mine].tobytes())
            found["busy"].append((count[mine] >= busy_from).tobytes())
        return pa.Table.from_batches([_rows(found, out)])

    sent = layout.classes.select("g", "text").mapInArrow(send, "bucket int, g int, keys binary, shared binary")
    return sent.groupBy("bucket").applyInArrow(meet, "g int, keys binary, busy binary")


_PACK = pa.schema([("bucket", pa.int32()), ("g", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_PACK_SQL = "bucket int, g int, keys binary, counts binary"


def places(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 40-bit remainder of keys; together they stand for the key."""
    return ((keys & np.uint64(0xFFFFFF)) % np.uint64(n)).astype(np.int64), keys >> np.uint64(24)


def counts(layout: Layout, keys_of: Callable) -> DataFrame:
    """(bucket, g, keys, counts): for every group, the keys of its texts that two or more classes
    hold, as 40-bit remainders in five bytes each, with their counts (chunks, 255 at most).

    The count is the same in every group, so it can order keys globally.
    """
    n = 4 * layout.width

    def send(batches):
        for batch in batches:
            for g, at in by_group(batch):
                for keys, docs in keys_of(batch.column("text").take(pa.array(at))):
                    keys, shared = shared_in_chunk(keys, docs)
                    bucket, rest = places(keys, n)
                    found = {f.name: [] for f in _PACK}
                    for b, where in split_by(bucket, n):
                        found["bucket"].append(b)
                        found["g"].append(g)
                        found["keys"].append(five_bytes(rest[where]))
                        found["counts"].append((shared[where] + np.uint8(1)).astype(np.uint8).tobytes())
                    yield _rows(found, _PACK)

    def meet(table: pa.Table) -> pa.Table:
        keys = read_five(table["keys"])
        count = np.frombuffer(b"".join(table["counts"].to_pylist()), dtype=np.uint8)
        g = np.repeat(np.asarray(table["g"]), [len(x) // 5 for x in table["keys"].to_pylist()])
        order = np.lexsort((g, keys))
        keys, count, g = keys[order], count[order], g[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
        sums = np.add.reduceat(count.astype(np.int64), first) if len(first) else count
        total = np.repeat(np.minimum(sums, 255), np.diff(np.append(first, len(keys)))).astype(np.uint8)
        keep = total > 1
        keep[1:] &= (keys[1:] != keys[:-1]) | (g[1:] != g[:-1])
        keys, total, g = keys[keep], total[keep], g[keep]
        found = {f.name: [] for f in _PACK}
        for value in np.unique(g):
            mine = g == value
            found["bucket"].append(table["bucket"][0].as_py())
            found["g"].append(int(value))
            found["keys"].append(five_bytes(keys[mine]))
            found["counts"].append(total[mine].tobytes())
        return pa.Table.from_batches([_rows(found, _PACK)])

    return layout.classes.select("g", "text").mapInArrow(send, _PACK_SQL).groupBy("bucket").applyInArrow(meet, _PACK_SQL)


def five_bytes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def read_five(column) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :5] = raw
    return out.view("<u8").ravel().astype(np.uint64)


class Counts:
    """The counts of the keys that a group's texts share with others; 0 for keys of one text."""

    def __init__(self, table: pa.Table, n: int):
        keys = read_five(table["keys"])
        bucket = np.repeat(np.asarray(table["bucket"]).astype(np.uint64), [len(x) // 5 for x in table["keys"].to_pylist()])
        keys |= bucket << np.uint64(40)
        count = np.frombuffer(b"".join(table["counts"].to_pylist()), dtype=np.uint8)
        order = np.argsort(keys)
        self.keys, self.count, self.n = keys[order], count[order], n

    def of(self, keys: np.ndarray) -> np.ndarray:
        bucket, rest = places(keys, self.n)
        at = find_in(self.keys, rest | (bucket.astype(np.uint64) << np.uint64(40)))
        return np.where(at >= 0, self.count[at], 0).astype(np.uint8) if len(self.count) else np.zeros(len(keys), np.uint8)


def read_census(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of one group and whether each is busy."""
    keys = np.frombuffer(b"".join(table["keys"].to_pylist()), dtype=np.uint64)
    busy = np.frombuffer(b"".join(table["busy"].to_pylist()), dtype=bool)
    order = np.argsort(keys)
    return keys[order], busy[order]


def find_in(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key in ``sorted_keys``, or -1."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


def with_groups(layout: Layout, other: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``fn(texts, other)`` for every group; only ``other`` is shuffled."""
    return layout.classes.groupBy("g").cogroup(other.groupBy("g")).applyInArrow(fn, schema)
