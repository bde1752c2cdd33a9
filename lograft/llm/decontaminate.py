"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores, for every block of training documents, the postings (positions)
of all its terms.  A block is about a megabyte of text and one row of the index
table, so the index is spread over the cluster by documents and no term's list,
however frequent, is gathered anywhere.  It is built once and answers any test set.

``test_phrases`` cuts the test items into windows in Spark and stores which item holds which
window; equal windows become one *phrase*.

``search`` answers phrases block by block.  A phrase starts from its rarest term
in the block; every next term's list, shifted by the term's offset in the
phrase, is intersected with what is left.  A phrase with a term that the block
lacks is dropped at once.  With ``slop`` > 0 a term may stand up to that many
words away from its exact place (proximity).  Only documents with a hit leave the
search; the items of a phrase are joined to them afterwards.

The phrases are the only thing sent to all tasks, in slices of about ``slice_bytes`` that are
dealt by hash, each answered over the whole index; a benchmark of ordinary size is one slice.

Defined results: null or empty texts have no words; an item with fewer words
than a window is one window; items without words match nothing; an item_id that
occurs twice counts once, a null one marks words but is not listed; rows that
share a doc_id are judged each on its own text; extra columns are ignored;
empty tables give empty results (documents) or nothing hit (benchmark).
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from . import rolling as R

WINDOW = 10
SLICE_BYTES = 16 << 20
#: Separators of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``, applied after lower-casing.
BREAKS = np.ones(256, dtype=bool)
BREAKS[ord("0"):ord("9") + 1] = False
BREAKS[ord("a"):ord("z") + 1] = False
BREAKS[0x80:] = False

#: Windows of one item that leave a task at a time.
_STEP = 1 << 14
_INDEX_SQL = "doc_ids array<bigint>, marks array<bigint>, sizes array<bigint>, terms binary, lists binary, positions binary"
_INDEX = pa.schema([("doc_ids", pa.list_(pa.int64())), ("marks", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                    ("terms", pa.binary()), ("lists", pa.binary()), ("positions", pa.binary())])
_WINDOWS = pa.schema([("item", pa.string()), ("terms", pa.binary())])
_HITS_SQL = "doc_id bigint, mark bigint, spans array<bigint>, phrases array<binary>"
_HITS = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("spans", pa.list_(pa.int64())), ("phrases", pa.list_(pa.binary()))])


def terms_of(column, limit: int = 1 << 20):
    """(first row, term hashes, word offsets of the documents) per block of texts."""
    for row, buf, offsets in R.chunks(column, limit):
        buf = R.LOWER[buf]
        starts, ends, bounds = R.word_bounds(buf, offsets, BREAKS)
        yield row, R.byte_hash(R.byte_sums(buf), starts, ends), bounds


def test_phrases(benchmark: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Stored tables: (item, phrase) once for every window of an item, and (phrase, terms) for every distinct window.

    terms are the window's word hashes end to end, phrase their digest.
    """
    def cut(batches):
        for batch in batches:
            items = batch.column("item").to_pylist()
            for row, terms, bounds in terms_of(batch.column("text")):
                for d in range(len(bounds) - 1):
                    own = terms[bounds[d]:bounds[d + 1]]
                    if not len(own):
                        continue
                    views = np.lib.stride_tricks.sliding_window_view(own, min(window, len(own)))
                    for at in range(0, len(views), _STEP):
                        part = [w.tobytes() for w in views[at:at + _STEP]]
                        yield pa.RecordBatch.from_arrays([pa.array([items[row + d]] * len(part), pa.string()),
                                                          pa.array(part, pa.binary())], schema=_WINDOWS)

    spark = benchmark.sparkSession
    windows, held, distinct = (scratch_path(spark, f"test-{n}") for n in ("windows", "items", "phrases"))
    benchmark.select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(cut, "item string, terms binary") \
        .select("item", F.unhex(F.md5("terms")).alias("phrase"), "terms").write.parquet(windows)
    rows = spark.read.schema("item string, phrase binary, terms binary").parquet(windows)
    rows.where("item IS NOT NULL").select("item", "phrase").distinct().write.parquet(held)
    rows.select("phrase", "terms").distinct().write.parquet(distinct)
    return (spark.read.schema("item string, phrase binary").parquet(held),
            spark.read.schema("phrase binary, terms binary").parquet(distinct))


test_phrases.__test__ = False  # not a test


def build_index(docs: DataFrame) -> DataFrame:
    """Store the postings of all terms; one row per block of documents."""
    spark = docs.sparkSession

    def index(batches):
        for batch in batches:
            ids, marks = batch.column("doc_id").to_pylist(), batch.column("mark").to_pylist()
            for row, words, bounds in terms_of(batch.column("text")):
                n = len(bounds) - 1
                positions = np.argsort(words, kind="stable")
                held, count = np.unique(words[positions], return_counts=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[row:row + n]], pa.list_(pa.int64())),
                    pa.array([marks[row:row + n]], pa.list_(pa.int64())),
                    pa.array([np.diff(bounds)], pa.list_(pa.int64())),
                    pa.array([held.astype(np.uint64).tobytes()], pa.binary()),
                    pa.array([count.astype(np.int32).tobytes()], pa.binary()),
                    pa.array([positions.astype(np.int32).tobytes()], pa.binary())], schema=_INDEX)

    path = scratch_path(spark, "positional-index")
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text").mapInArrow(index, _INDEX_SQL) \
        .write.option("compression", "zstd").parquet(path)
    return spark.read.schema(_INDEX_SQL).parquet(path)


class Block:
    """The postings of one block, by the term numbers of a sorted vocabulary."""

    def __init__(self, vocabulary: np.ndarray, terms: bytes, lists: bytes, positions: bytes, bounds: np.ndarray):
        held, sizes = np.frombuffer(terms, dtype=np.uint64), np.frombuffer(lists, dtype=np.int32).astype(np.int64)
        self.count = self.begin = np.zeros(len(vocabulary), dtype=np.int64)
        if len(held):
            at = np.minimum(np.searchsorted(held, vocabulary), len(held) - 1)
            self.count = np.where(held[at] == vocabulary, sizes[at], 0)
            self.begin = (np.cumsum(sizes) - sizes)[at]
        self.positions = np.frombuffer(positions, dtype=np.int32)
        self.bounds = bounds

    def postings(self, term: int) -> np.ndarray:
        return self.positions[self.begin[term]:self.begin[term] + self.count[term]]

    def find(self, terms: list[int], slop: int = 0) -> np.ndarray:
        """Starts of a phrase given as term numbers."""
        by_rarity = sorted(range(len(terms)), key=lambda o: self.count[terms[o]])
        starts = self.postings(terms[by_rarity[0]]).astype(np.int64) - by_rarity[0]
        # the phrase must lie within the document that holds its rarest term
        doc = np.searchsorted(self.bounds, starts + by_rarity[0], side="right") - 1
        starts = starts[(starts >= self.bounds[doc]) & (starts + len(terms) <= self.bounds[doc + 1])]
        for o in by_rarity[1:]:
            if not len(starts):
                break
            there = self.postings(terms[o])
            low = np.searchsorted(there, starts + o - slop)
            starts = starts[low < np.searchsorted(there, starts + o + slop, side="right")]
        return starts


def search(index: DataFrame, phrases: pa.Table, slop: int = 0) -> DataFrame:
    """Per indexed document with a hit: doc_id, mark (hash of the text), spans (begin, end pairs of hit words) and the
    phrases that occur."""
    by_size: dict[int, list[int]] = defaultdict(list)
    names, terms = phrases["phrase"].to_pylist(), phrases["terms"].to_pylist()
    for i, x in enumerate(terms):
        by_size[len(x) // 8].append(i)
    vocabulary = np.unique(np.frombuffer(b"".join(terms), dtype=np.uint64))
    known = index.sparkSession.sparkContext.broadcast((vocabulary, [
        (np.searchsorted(vocabulary, np.frombuffer(b"".join(terms[i] for i in own), dtype=np.uint64)).reshape(-1, size),
         [names[i] for i in own]) for size, own in by_size.items()]))

    def match(batches):
        vocab, wanted = known.value
        for batch in batches:
            column = {c: batch.column(c) for c in batch.schema.names}
            for r in range(batch.num_rows):
                row = {c: v[r].as_py() for c, v in column.items()}
                bounds = np.concatenate(([0], np.cumsum(row["sizes"], dtype=np.int64)))
                block = Block(vocab, row["terms"], row["lists"], row["positions"], bounds)
                depth = np.zeros(int(bounds[-1]) + 1, dtype=np.int32)
                held: dict[int, list[bytes]] = defaultdict(list)
                for numbers, keys in wanted:
                    size = numbers.shape[1]
                    for i in np.flatnonzero(block.count[numbers].min(axis=1) > 0):
                        starts = block.find(numbers[i].tolist(), slop)
                        if not len(starts):
                            continue
                        np.add.at(depth, starts, 1)
                        np.add.at(depth, starts + size, -1)
                        for d in np.unique(np.searchsorted(bounds, starts, side="right") - 1).tolist():
                            held[d].append(keys[i])
                hit = np.cumsum(depth[:-1]) > 0
                spans = [np.stack(R.runs_of(hit[bounds[d]:bounds[d + 1]]), axis=1).ravel().tolist() for d in held]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["doc_ids"][d] for d in held], pa.int64()), pa.array([row["marks"][d] for d in held], pa.int64()),
                    pa.array(spans, pa.list_(pa.int64())), pa.array(list(held.values()), pa.list_(pa.binary()))], schema=_HITS)

    return index.mapInArrow(match, _HITS_SQL)


def _merged(hits: DataFrame) -> DataFrame:
    """The spans that several slices of the phrases found in a text, put together: doc_id, mark, spans."""
    pairs = F.transform(F.sequence(F.lit(0), F.shiftright(F.size("spans"), 1) - 1), lambda i: F.struct(
        F.get("spans", 2 * i).alias("a"), F.get("spans", 2 * i + 1).alias("z")))
    one = hits.select("doc_id", "mark", pairs.alias("pairs")).groupBy("doc_id", "mark").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("pairs")))).alias("pairs"))
    joined = F.aggregate("pairs", F.array().cast("array<bigint>"), lambda s, p: F.when(
        (F.size(s) > 0) & (F.element_at(s, -1) >= p["a"]),
        F.concat(F.slice(s, 1, F.size(s) - 1), F.array(F.greatest(F.element_at(s, -1), p["z"]))))
        .otherwise(F.concat(s, F.array(p["a"], p["z"]))))
    return one.select("doc_id", "mark", joined.alias("spans"))


def _same(left: str, right: str):
    """The same text of the same row: ids may be null."""
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (F.col(f"{left}.mark") == F.col(f"{right}.mark"))


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int, slop: int,
              slice_bytes: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The index, the stored hits of all phrases in it, and the items of the phrases."""
    spark = docs.sparkSession
    items, phrases = test_phrases(benchmark, window)
    index = build_index(docs)
    size = phrases.agg(F.sum(F.octet_length("terms"))).first()[0] or 0
    slices = -(-size // slice_bytes)
    path = scratch_path(spark, "phrase-hits")
    spark.createDataFrame([], _HITS_SQL).write.parquet(path)
    for i in range(slices):
        own = phrases.where(F.pmod(F.xxhash64("phrase"), F.lit(slices)) == i).toArrow()
        if own.num_rows:
            search(index, own, slop).write.mode("append").parquet(path)
    return index, spark.read.schema(_HITS_SQL).parquet(path), items


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0,
                  slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per document: doc_id, mark, n_words, spans, items, n_hit, n_items, items_sha256, contaminated."""
    index, hits, owners = find_hits(docs, benchmark, window, slop, slice_bytes)
    listed = hits.select("doc_id", "mark", F.explode("phrases").alias("phrase")).distinct().join(owners, "phrase") \
        .groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set("item")).alias("items"))
    rows = index.select(F.inline(F.arrays_zip("doc_ids", "marks", "sizes"))).toDF("doc_id", "mark", "n_words")
    got = rows.alias("r").join(_merged(hits).alias("h"), _same("r", "h"), "left").join(listed.alias("i"), _same("r", "i"), "left") \
        .select("r.doc_id", "r.mark", "n_words", F.coalesce("spans", F.array().cast("array<bigint>")).alias("spans"),
                F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    n_hit = F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).cast("long").alias("sign")),
                        lambda s, x: F.struct((s["sum"] + s["sign"] * x).alias("sum"), (-s["sign"]).alias("sign")),
                        lambda s: s["sum"])
    return (got.withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("long"))
            .withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
            .withColumn("contaminated", F.col("n_hit") > 0))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark; rows are known by doc_id and text."""
    _, hits, _ = find_hits(docs, benchmark, window, 0, SLICE_BYTES)
    hit = hits.select(F.col("doc_id").alias("bad_id"), "mark").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("m"))
    same = F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("m") == F.col("mark"))
    return rows.join(hit, same, "left_anti").select("row.*")
