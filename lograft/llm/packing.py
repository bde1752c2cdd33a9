"""Best-fit packing into bins of several permitted lengths.

Documents become pieces of at most the largest permitted length.  Pieces are
dealt to groups of bounded size by a hash of their row and number, so neither a
hot source nor one very long document makes a group larger than others, and each
group is packed on its own:

* pieces are taken from the longest down; each goes to the open bin whose free
  space fits it best (the smallest that is large enough);
* if none fits, a bin is opened: of the permitted lengths that hold the piece, the one
  with the least cost per token that it can be filled with.  The fill is priced from the
  histogram of the pieces still to be placed (the piece, then again and again the
  largest that goes into the rest), so lengths compete from the first bin to the last.
  A bin of c tokens costs ``overhead + c + c * c / attention``: attention grows with the
  square of the length and equals the rest of the work at ``attention`` tokens.  Without the
  square the longest length could take the contents of two bins of half its length for less,
  and nothing else would ever be opened;
* at the end every bin is cut down to the shortest permitted length that holds
  its contents.

Tokens are words ``[^\\x20\\x09-\\x0D]+``.

Defined results: a text without words, null or empty, is one row without a bin;
repeated rows are packed each; rows without a doc_id are packed like others;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

LENGTHS, OVERHEAD, ATTENTION = (512, 1024, 2048, 4096), 16, 8192
GROUP_TOKENS = 1 << 22


def bin_cost(length: int, overhead: int = OVERHEAD, attention: int = ATTENTION) -> float:
    return overhead + length + length * length / attention


def reachable_fill(piece: int, length: int, counts: list[int], mask: int) -> int:
    """Tokens that a bin of ``length`` with ``piece`` can hold of the remaining pieces (``counts`` by size, bits in ``mask``)."""
    space = length - piece
    below = mask & ((2 << space) - 1)
    while below:
        size = below.bit_length() - 1
        space -= min(counts[size], space // size) * size
        below &= (2 << min(space, size - 1)) - 1
    return length - space


def best_fit(sizes: list[int], lengths=LENGTHS, overhead: int = OVERHEAD,
             attention: int = ATTENTION) -> tuple[list[int], list[int], list[int], list[int]]:
    """For pieces in descending order: bin and offset of each, the final length of every bin and the length it was opened with."""
    counts, waiting = [0] * (max(lengths) + 1), 0  # pieces still to be placed; bit s: one of size s
    for n in sizes:
        counts[n] += 1
        waiting |= 1 << n
    cost = {c: bin_cost(c, overhead, attention) for c in lengths}
    free: dict[int, list[int]] = {}  # open bins by free space
    mask = 0  # bit s: some bin has s tokens free
    where, offset, used, opened = [], [], [], []
    for n in sizes:
        counts[n] -= 1
        if not counts[n]:
            waiting ^= 1 << n
        fitting = mask >> n
        if fitting:
            space = n + (fitting & -fitting).bit_length() - 1
            bin_ = free[space].pop()
            if not free[space]:
                mask ^= 1 << space
        else:
            space = min((c for c in lengths if c >= n), key=lambda c: (cost[c] / reachable_fill(n, c, counts, waiting), c))
            bin_ = len(used)
            used.append(0)
            opened.append(space)
        where.append(bin_)
        offset.append(used[bin_])
        used[bin_] += n
        if space > n:
            free.setdefault(space - n, []).append(bin_)
            mask |= 1 << (space - n)
    return where, offset, [min(c for c in lengths if c >= u) for u in used], opened


def pack_documents(docs: DataFrame, lengths=LENGTHS, overhead: int = OVERHEAD, attention: int = ATTENTION,
                   group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """doc_id, row_no, piece, first_token, n_tokens, bin, bin_length, bin_offset: one row per piece."""
    spark, longest = docs.sparkSession, max(lengths)
    path = scratch_path(spark, "piece-sizes")
    # the only pass over the texts; once written, the row numbers are fixed
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row_no"),
                F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("n")) \
        .write.parquet(path)
    rows = spark.read.parquet(path)
    total = rows.agg(F.sum("n")).first()[0] or 0
    groups = max(1, -(-total // group_tokens))
    last = F.greatest(F.ceil(F.col("n") / longest) - 1, F.lit(0))
    pieces = (rows.select("doc_id", "row_no", "n", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("piece"))
              .select("doc_id", "row_no", "piece", (F.col("piece") * longest).alias("first_token"),
                      F.least(F.col("n") - F.col("piece") * longest, F.lit(longest)).cast("int").alias("n_tokens"))
              .withColumn("g", F.pmod(F.xxhash64("row_no", "piece"), F.lit(groups))))
    sql = "doc_id bigint, row_no bigint, piece bigint, first_token bigint, n_tokens int, bin bigint, bin_length int, bin_offset int"

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n_tokens", "descending"), ("row_no", "ascending"), ("piece", "ascending")])
        g = table["g"][0].as_py()
        sizes = [n for n in table["n_tokens"].to_pylist() if n]
        where, offset, final, _ = best_fit(sizes, lengths, overhead, attention)
        none = [None] * (table.num_rows - len(sizes))
        return table.select(["doc_id", "row_no", "piece", "first_token", "n_tokens"]) \
            .append_column("bin", pa.array([(g << 32) + b for b in where] + none, pa.int64())) \
            .append_column("bin_length", pa.array([final[b] for b in where] + none, pa.int32())) \
            .append_column("bin_offset", pa.array(offset + none, pa.int32()))

    return pieces.groupBy("g").applyInArrow(pack, sql)
