"""Sharding as vector bin packing of bytes, tokens and rows.

Rows are packed by *groups* of equal texts.  Very many small groups share a
*bundle* (a hash of the text), so the packer sees a bounded number of items
whatever the corpus size: ``bundles`` bundles and the groups that hold more than
``large`` of all bytes, tokens or rows, of which there are at most 3 / large.
A group above half a shard could not be balanced whole and is split into pieces
by doc_id (by row, where it is null); equal texts otherwise stay together.

The packer takes items from the largest down and places each in the shard where
the dot product of the item's vector with the shard's residual capacity is
highest.  Shares of bytes weigh most, since the law kept is ``bytes``: the
shards' byte sizes are near equal.

Slots are numbered without gaps: an item's rows are numbered on their own and
moved by the row counts of the items placed in the shard before it, so no
shard's rows meet in one task.  The rows of a large group are dealt to parts of
about ``large`` of all rows, each numbered on its own in the same way, so a group
that stays together in its shard does not meet in one task either.

Defined results: null texts have no bytes and the crc32 of the empty string; rows
without a doc_id are placed like others; repeated rows each take a slot of their
own; equal sort keys get their slots in any order; a single text above a shard's
share stays whole; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path

SHARDS, BUNDLES, LARGE = 16, 8192, 1 / 1024
WEIGHTS = (4.0, 1.0, 1.0)  # bytes, tokens, rows
_SIZES = ("bytes", "tokens", "rows")


def pack(items: np.ndarray, shards: int, weights=WEIGHTS) -> np.ndarray:
    """The shard of every item (rows of bytes, tokens, row counts)."""
    total = np.maximum(items.sum(axis=0), 1).astype(float)
    vectors = items / total * shards  # a full shard is 1 in every dimension
    residual = np.ones((shards, items.shape[1]))
    out = np.zeros(len(items), dtype=np.int64)
    scale = np.asarray(weights)
    for i in np.lexsort((np.arange(len(items)), -vectors.max(axis=1))):
        # a resource that a shard has used up counts against it
        out[i] = int(np.argmax((residual * scale) @ vectors[i]))
        residual[out[i]] -= vectors[i]
    return out


def shard_rows(docs: DataFrame, shards: int = SHARDS, bundles: int = BUNDLES, large: float = LARGE) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, tokens per row of ``docs``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    path = scratch_path(spark, "shard-sizes")
    # the only pass over the texts; everything after it reads some forty bytes a row
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("bytes"),
                F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
                F.crc32(text.cast("binary")).alias("crc"), F.xxhash64(text).alias("h1"),
                F.xxhash64(F.lit(shards), text).alias("h2"), F.monotonically_increasing_id().alias("row_no")).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("rows", F.lit(1).cast("long"))
    sums = [F.sum(c).alias(c) for c in _SIZES]
    total = rows.agg(*sums).first()
    limits = {c: (total[c] or 0) for c in _SIZES}
    groups = rows.groupBy("h1", "h2").agg(*sums)
    is_large = F.lit(False)
    for c in _SIZES:
        is_large = is_large | (F.col(c) > large * limits[c])
    share = F.greatest(*[F.col(c) * shards / F.lit(max(limits[c], 1)) for c in _SIZES])
    # at most 3 / large groups
    big = F.broadcast(groups.where(is_large).select(
        "h1", "h2", F.when(share > 0.5, F.ceil(share * 8).cast("int")).otherwise(F.lit(1)).alias("pieces"),
        F.ceil(F.col("rows") / F.lit(large * max(limits["rows"], 1))).cast("int").alias("parts")))
    # h2 tells large groups of one bundle apart
    placed = (rows.join(big, ["h1", "h2"], "left")
              .withColumn("bundle", F.pmod("h1", F.lit(bundles)).cast("int"))
              .withColumn("own", F.when(F.col("pieces").isNotNull(), F.col("h2")))
              .withColumn("piece", F.when(F.col("pieces").isNotNull(),
                                          F.pmod(F.xxhash64(F.coalesce("doc_id", "row_no")), "pieces")))
              .withColumn("part", F.pmod(F.xxhash64(F.lit(shards), "row_no"), F.ceil(
                  F.coalesce(F.col("parts") / F.col("pieces"), F.lit(1)))).cast("int"))
              .select("doc_id", "bytes", "tokens", "rows", "crc", "bundle", "own", "piece", "part"))
    # bounded: bundles + parts of large groups, of which there are at most 1 / large more than pieces
    parts = placed.groupBy("bundle", "own", "piece", "part").agg(*sums).orderBy("bundle", "own", "piece", "part").collect()
    items = [list(same) for _, same in groupby(parts, key=lambda r: (r.bundle, r.own, r.piece))]
    shard = pack(np.array([[sum(r[c] for r in item) for c in _SIZES] for item in items], dtype=float).reshape(-1, 3), shards)
    first, plan = [0] * shards, []
    for item, s in zip(items, shard.tolist()):
        for r in item:
            plan.append((r.bundle, r.own, r.piece, r.part, s, first[s]))
            first[s] += r.rows
    plan = F.broadcast(spark.createDataFrame(plan, "bundle int, own long, piece long, part int, shard int, first long"))
    within = Window.partitionBy("bundle", "own", "piece", "part").orderBy("doc_id", "crc", "bytes")
    a, b = placed.withColumn("nth", F.row_number().over(within) - 1).alias("a"), plan.alias("b")
    same = ((F.col("a.bundle") == F.col("b.bundle")) & F.col("a.own").eqNullSafe(F.col("b.own"))
            & F.col("a.piece").eqNullSafe(F.col("b.piece")) & (F.col("a.part") == F.col("b.part")))
    return a.join(b, same).select(
        "doc_id", F.col("bytes").alias("size"), F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("first") + F.col("nth")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "tokens")
