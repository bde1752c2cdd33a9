"""Merkle dataset manifest: a content-addressed DAG, and proofs found by descent.

Rows are leaves.  Per source the leaves, in the order of doc_id, are folded three
by three into a subroot; the subroots, in the order of their sources, are folded
likewise into the root.

* ``rank_nodes`` numbers the leaves of every source without bringing a source
  together: a range partitioning by (source, doc_id), positions inside the
  partitions and one running count over the partitions.
* ``build`` makes the digest -> children records.  A *block* is 3**HEIGHT
  neighbouring nodes; a task folds a block up to one node and stores the records
  that it made, so a tree of n leaves takes log(n) / (HEIGHT log 3) rounds.
* ``descend`` starts from the root.  A request names a node by its rank; in every
  block it walks from the block's digest to the children, one digit of the rank
  (base 3) at a time, and keeps the children that were not selected.  The steps
  found in a block are a segment of the path, and all requests below a node share
  the segments above it.  At the leaves the segments, found from the root, are
  reversed to run from the leaf to the root.

Defined results: a null value counts as ``-``, null doc_ids come last in their
source and are not tampered with; rows that share a doc_id are ordered by their
leaves, equal rows have equal leaves and one place each; the null source is a
source like any other and comes first; extra columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

FANOUT = 3
HEIGHT = 5  # levels of a block: 243 nodes
BLOCK = FANOUT ** HEIGHT


def digest(children: list[bytes]) -> bytes:
    """H of digests as lowercase hex text, without separators."""
    return hashlib.sha256("".join(x.hex() for x in children).encode()).digest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(_field(F.col("doc_id").cast("long")), _field(F.col("source")), _field(F.col("lang")),
                                   _field(F.col("n_chars").cast("long")), _field(text)), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, tree (the source as a sortable key that is never null), digest, shown (the tampered leaf)."""
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    broken = tampered & F.contains("text", F.lit("\n"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source"))).alias("tree"),
        leaf_digest(F.col("text")).alias("digest"),
        F.when(broken, leaf_digest(F.replace(F.col("text"), F.lit("\n"), F.lit("")))).alias("shown"),
        F.monotonically_increasing_id().alias("line"))


def _stored(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.parquet(path)


def rank_nodes(spark: SparkSession, nodes: DataFrame, order: list, name: str) -> DataFrame:
    """``nodes`` with rank (from 0) and size (number of nodes) inside their tree; ``order`` begins with the tree."""
    placed = _stored(spark, nodes.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33)
    parts = placed.groupBy("tree", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")
    parts = parts.select(F.col("tree").alias("of"), "part", (F.sum("n").over(tree.orderBy("part")) - F.col("n") - F.col("first")).alias("shift"),
                         F.sum("n").over(tree).alias("size"))
    ranked = placed.join(parts, (F.col("tree") == F.col("of")) & (part == F.col("part")))
    return ranked.select(*nodes.columns, (F.col("at") + F.col("shift")).alias("rank"), "size")


_BUILT = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("digest", pa.binary()),
                    ("children", pa.list_(pa.binary()))])
_BUILT_SQL = "tree string, block bigint, size bigint, digest binary, children array<binary>"


def _fold(nodes: pa.Table) -> pa.Table:
    """Records of one block, and its top node (children null), whose size is that of the next tier."""
    nodes = nodes.sort_by("rank")
    tree, block, size = nodes["tree"][0].as_py(), nodes["block"][0].as_py(), nodes["size"][0].as_py()
    level, records = nodes["digest"].to_pylist(), {}
    for _ in range(HEIGHT):
        if size == 1:
            break
        runs = [level[i:i + FANOUT] for i in range(0, len(level), FANOUT)]
        level = [digest(x) for x in runs]
        records.update(zip(level, runs))  # one record a digest: equal contents share theirs
        size = -(-size // FANOUT)
    found = [*records.items(), (level[0], None)]
    return pa.table([pa.array([tree] * len(found)), pa.array([block] * len(found), pa.int64()),
                     pa.array([size] * len(found), pa.int64()), pa.array([d for d, _ in found], pa.binary()),
                     pa.array([c for _, c in found], pa.list_(pa.binary()))], schema=_BUILT)


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("rank") / BLOCK).cast("long"))


def build(spark: SparkSession, nodes: DataFrame, name: str) -> list[DataFrame]:
    """Tiers of stored records and top nodes, from the leaves up; the last tier's top nodes are the roots."""
    tiers = []
    while True:
        folded = _blocks(nodes.select("tree", "rank", "size", "digest")).groupBy("tree", "block").applyInArrow(_fold, _BUILT_SQL)
        tiers.append(_stored(spark, folded, f"{name}-{len(tiers)}"))
        tops = tiers[-1].where(F.col("children").isNull())
        if not (tops.agg(F.max("size")).first()[0] or 0) > 1:
            return tiers
        nodes = tops.select("tree", F.col("block").alias("rank"), "size", "digest")


#: A request: the digest of a block's top node, the path from the root to it, and what it carries.
_REQUEST_SQL = "tree string, rank bigint, digest binary, path array<binary>, root binary, subroot binary"
_REQUEST = pa.schema([("tree", pa.string()), ("rank", pa.int64()), ("digest", pa.binary()), ("path", pa.list_(pa.binary())),
                      ("root", pa.binary()), ("subroot", pa.binary())])


def walk(top: bytes, records: dict[bytes, list[bytes]], depth: int, rank: int) -> tuple[bytes, list[bytes]]:
    """The node of ``rank`` below ``top`` and the steps to it: the digit, then the children that were not selected."""
    steps, node = [], top
    for k in range(depth - 1, -1, -1):
        digit = rank // FANOUT ** k % FANOUT
        children = records[node]
        steps.append(bytes([digit]) + b"".join(c for i, c in enumerate(children) if i != digit))
        node = children[digit]
    return node, steps


def _read_block(asked: pa.Table) -> tuple[dict, dict, int]:
    """The request of a block, its records, and how many levels they span."""
    records, request = {}, None
    for row in asked.to_pylist():
        if row["children"] is None:
            request = row
        else:
            records[row["digest"]] = row["children"]
    depth, node = 0, request["digest"]
    while node in records:
        node, depth = records[node][0], depth + 1
    return request, records, depth


def _segments(nodes: pa.Table, asked: pa.Table) -> pa.Table:
    request, records, depth = _read_block(asked)
    found = []
    for rank in nodes["rank"].to_pylist():
        node, steps = walk(request["digest"], records, depth, rank % BLOCK)
        found.append((node, request["path"] + steps))
    n = len(found)
    return pa.table([nodes["tree"].combine_chunks(), nodes["rank"].combine_chunks(), pa.array([x for x, _ in found], pa.binary()),
                     pa.array([x for _, x in found], pa.list_(pa.binary())), pa.array([request["root"]] * n, pa.binary()),
                     pa.array([request["subroot"]] * n, pa.binary())], schema=_REQUEST)


def fold_path(node: bytes, path: list[bytes]) -> bytes:
    """The root that a node and its path, from the leaf up, lead to."""
    for step in path:
        run = [step[i:i + 32] for i in range(1, len(step), 32)]
        node = digest([*run[:step[0]], node, *run[step[0]:]])
    return node


_PROOF_SQL = ("doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
              "verified boolean")
_PROOF = pa.schema([("doc_id", pa.int64()), *((x, pa.string()) for x in ("leaf", "subroot", "root", "proof_sha256", "folded_root")),
                    ("verified", pa.bool_())])


def _proofs(nodes: pa.Table, asked: pa.Table) -> pa.Table:
    """The last descent: one row per leaf, its path reversed and folded again."""
    request, records, depth = _read_block(asked)
    found = []
    for doc_id, rank, leaf, shown in zip(*(nodes[c].to_pylist() for c in ("doc_id", "rank", "digest", "shown"))):
        node, steps = walk(request["digest"], records, depth, rank % BLOCK)
        if node != leaf:
            raise ValueError("a request by rank did not lead to its leaf")
        path = (request["path"] + steps)[::-1]
        proof = hashlib.sha256("".join(x[1:].hex() for x in path).encode()).hexdigest()
        folded = fold_path(leaf if shown is None else shown, path)
        found.append((doc_id, leaf.hex(), request["subroot"].hex(), request["root"].hex(), proof, folded.hex(),
                      folded == request["root"]))
    columns = zip(*found) if found else [[]] * len(_PROOF)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _PROOF)], schema=_PROOF)


def _ask(tier: DataFrame, requests: DataFrame) -> DataFrame:
    """Records of a tier and the requests for its blocks, in one frame; a request's rank is the block."""
    records = tier.where(F.col("children").isNotNull()).select("tree", "block", "digest", "children")
    asked = requests.select("tree", F.col("rank").alias("block"), "digest", "path", "root", "subroot")
    return records.unionByName(asked, allowMissingColumns=True)


def descend(spark: SparkSession, tiers: list[DataFrame], requests: DataFrame, name: str) -> DataFrame:
    """Requests for the blocks of the lowest tier, from requests for the roots (``_REQUEST``)."""
    for k in range(len(tiers) - 1, 0, -1):
        nodes = _blocks(tiers[k - 1].where(F.col("children").isNull()).select("tree", F.col("block").alias("rank")))
        requests = _stored(spark, nodes.groupBy("tree", "block").cogroup(_ask(tiers[k], requests).groupBy("tree", "block"))
                           .applyInArrow(_segments, _REQUEST_SQL), f"{name}-{k}")
    return requests


def _roots(tiers: list[DataFrame]) -> DataFrame:
    return tiers[-1].where(F.col("children").isNull()).select("tree", "digest")


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified per row of ``docs``."""
    spark = docs.sparkSession
    rows = _stored(spark, leaves(docs), "merkle-leaves")
    ranked = _stored(spark, rank_nodes(spark, rows, [F.col("tree"), F.col("doc_id").asc_nulls_last(), F.col("digest"), F.col("line")],
                                       "merkle-order"), "merkle-ranked")
    tiers = build(spark, ranked, "merkle-source")
    # every tree is in every tier: one that is a single node already passes through unchanged
    subroots = _roots(tiers).select(F.lit("").alias("tree"), F.col("tree").alias("source_tree"), "digest")
    sources = _stored(spark, rank_nodes(spark, subroots, [F.col("tree"), F.col("source_tree")], "merkle-source-order"), "merkle-sources")
    upper = build(spark, sources, "merkle-root")
    top = _roots(upper).select("tree", F.lit(0).cast("long").alias("rank"), "digest", F.array().cast("array<binary>").alias("path"),
                               F.col("digest").alias("root"), F.lit(None).cast("binary").alias("subroot"))
    asked = descend(spark, upper, top, "merkle-down-root")
    nodes = _blocks(sources.select("tree", "rank"))
    found = nodes.groupBy("tree", "block").cogroup(_ask(upper[0], asked).groupBy("tree", "block")).applyInArrow(_segments, _REQUEST_SQL)
    requests = found.join(sources.select(F.col("rank").alias("place"), "source_tree"), F.col("rank") == F.col("place")).select(
        F.col("source_tree").alias("tree"), F.lit(0).cast("long").alias("rank"), "digest", "path", "root", F.col("digest").alias("subroot"))
    asked = descend(spark, tiers, _stored(spark, requests, "merkle-subroots"), "merkle-down-source")
    return (_blocks(ranked).groupBy("tree", "block").cogroup(_ask(tiers[0], asked).groupBy("tree", "block"))
            .applyInArrow(_proofs, _PROOF_SQL))
