"""Documents as bags of keys, and one value per key brought back to them.

A *chunk* is the documents of one Arrow batch.  Its distinct keys form a local
vocabulary, so every document is a list of small numbers and the chunk sends each
key once, however many of its documents hold it: a key that all documents hold
costs one entry a chunk.  The vocabulary goes to buckets by the keys' hashes,
where each distinct key meets all chunks that hold it and gets its value; the
values go back to the chunks.  All rows are stored once, in slices of documents
and of keys, compressed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Documents in a row of a stored table.
SLICE = 512
#: Bytes of text whose keys share a bucket.
BUCKET_BYTES = 128 << 20


def bucket_count(docs: DataFrame) -> int:
    """Buckets for the keys of all texts, from their measured bytes; a bucket's keys fit in one task."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(size // BUCKET_BYTES + 1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def stored(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def chunk_number(k: int) -> int:
    """Number of a task's k-th chunk; no two chunks of a table have the same."""
    return (TaskContext.get().partitionId() << 32) | k


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers as one compressed value, in 32 bits each where they fit; their lengths come first."""
    wide = [bool(len(x)) and int(x.max()) >= 1 << 32 for x in arrays]
    head = np.array([len(arrays), *(len(x) * (-1 if w else 1) for x, w in zip(arrays, wide))], dtype="<i8")
    raw = b"".join([head.tobytes(), *(x.astype("<u8" if w else "<u4").tobytes() for x, w in zip(arrays, wide))])
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(value: bytes) -> list[np.ndarray]:
    raw = pa.decompress(value[8:], decompressed_size=int.from_bytes(value[:8], "little"), codec="zstd", asbytes=True)
    count = int.from_bytes(raw[:8], "little")
    out, at = [], 8 * (count + 1)
    for n in np.frombuffer(raw, dtype="<i8", count=count, offset=8).tolist():
        out.append(np.frombuffer(raw, dtype="<u8" if n < 0 else "<u4", count=abs(n), offset=at))
        at += abs(n) * (8 if n < 0 else 4)
    return out


def count_up(owner: np.ndarray, key: np.ndarray, weight: np.ndarray | None, keys: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, key) in order, with the number of their entries or the sum of their weights."""
    both = owner.astype(np.int64) * max(keys, 1) + key
    order = np.argsort(both, kind="stable")
    both = both[order]
    first = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else np.zeros(0, dtype=np.int64)
    if weight is None:
        total = np.diff(np.append(first, len(both)))
    else:
        total = np.add.reduceat(weight[order], first) if len(first) else weight[:0]
    both = both[first]
    return both // max(keys, 1), both % max(keys, 1), total


def slices(n: int, owner: np.ndarray, key: np.ndarray, weight: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """(first document, one beyond the last, packed bags) of ``n`` documents; entries come from ``count_up``."""
    edges = np.searchsorted(owner, np.arange(n + 1))
    for a in range(0, n, SLICE):
        z = min(a + SLICE, n)
        mine = slice(edges[a], edges[z])
        step = np.diff(key[mine], prepend=0)
        first = edges[a:z][np.diff(edges[a:z + 1]) > 0] - edges[a]
        step[first] = key[mine][first]
        yield a, z, pack(np.diff(edges[a:z + 1]), step, weight[mine])


def read_slice(value: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document (in the slice), key and weight of every entry."""
    sizes, step, weight = (x.astype(np.int64) for x in unpack(value))
    total = np.cumsum(step)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    if len(total):
        at = np.minimum(starts, len(total) - 1)
        total -= (total[at] - step[at])[owner]
    return owner, total, weight


def sum_by(owner: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of whole numbers by owner, which is ascending."""
    ends = np.searchsorted(owner, np.arange(n + 1))
    total = np.concatenate(([0], np.cumsum(value, dtype=np.int64)))
    return total[ends[1:]] - total[ends[:-1]]
