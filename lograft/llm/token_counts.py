r"""Token counts: pieces counted once per distinct pre-token.

A byte-level BPE tokenizer splits every pre-token (word) for itself, so a text's
token count is the sum, over its words, of the word's number of pieces:

1. One pass cuts every text into words and stores, per chunk of documents, the
   chunk's vocabulary and each document's frequencies over it (``bags``).
2. The vocabularies meet by word; the tokenizer counts the pieces of every
   distinct word once.
3. The counts go back to the chunks and are summed with the frequencies.  No
   document's token ids are ever made.

A special string of the tokenizer inside a text is one token and ends the words
on both sides, as in the library.

Defined results: a null or empty text has no bytes and no tokens; rows without a
doc_id and rows that share one are counted each for themselves; extra columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bags
from . import rolling as R
from .tokens import BYTE_BPE, UNKNOWN, byte_tokenizer, own_words, special_strings, split_words, utf8_parts, word_lists

LIMIT = 512

_CHUNKS = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("at", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                     ("n_bytes", pa.list_(pa.int64())), ("specials", pa.list_(pa.int64())), ("body", pa.binary()),
                     ("words", pa.binary())])
_CHUNKS_SQL = ("chunk bigint, bucket int, at int, doc_ids array<bigint>, n_bytes array<bigint>, specials array<bigint>, "
               "body binary, words binary")


def _cut(name: str, buckets: int):
    """Arrow batches of (doc_id, n_bytes, words, text where words is null) as rows of ``_CHUNKS``."""
    def cut(batches):
        tokenizer, special = byte_tokenizer(name), special_strings(name)
        for k, batch in enumerate(batches):
            chunk, n = bags.chunk_number(k), batch.num_rows
            specials, others = np.zeros(n, dtype=np.int64), {}
            for row in np.flatnonzero(np.asarray(batch["text"].is_valid())):
                parts = [batch["text"][int(row)].as_py()]
                for s in special:
                    parts = [x for p in parts for x in p.split(s)]
                specials[row] = len(parts) - 1
                others[int(row)] = [w for p in parts for w in own_words(tokenizer, p)]
            flat, owner = word_lists(batch["words"], others)
            coded = flat.dictionary_encode()
            vocabulary = coded.dictionary
            data, offsets = utf8_parts(vocabulary)
            hashes = R.byte_hash(R.byte_sums(data), offsets[:-1], offsets[1:])
            bucket = ((hashes >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")  # a bucket's words stand together in the vocabulary
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.arange(len(order))
            local = np.asarray(coded.indices)
            owner, key, weight = bags.count_up(owner, rank[local], None, len(order))
            doc_ids, n_bytes = batch["doc_id"].to_pylist(), batch["n_bytes"].to_pylist()
            found = {f.name: [] for f in _CHUNKS}

            def add(**row):
                for column in found:
                    found[column].append(row.get(column))

            for a, z, body in bags.slices(n, owner, key, weight):
                add(chunk=chunk, doc_ids=doc_ids[a:z], n_bytes=n_bytes[a:z], specials=specials[a:z].tolist(), body=body)
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(edges)):
                mine = vocabulary.take(pa.array(order[edges[b]:edges[b + 1]]))
                data, offsets = utf8_parts(mine)
                add(chunk=chunk, bucket=int(b), at=int(edges[b]), body=bags.pack(np.diff(offsets)),
                    words=pa.compress(data.tobytes(), codec="zstd", asbytes=True))
            yield pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in _CHUNKS], schema=_CHUNKS)
    return cut


_COUNTS_SQL = "chunk bigint, at int, pieces binary"
_COUNTS = pa.schema([("chunk", pa.int64()), ("at", pa.int32()), ("pieces", pa.binary())])


def _words(sizes: np.ndarray, body: bytes) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    data = pa.decompress(body, decompressed_size=int(offsets[-1]), codec="zstd", asbytes=True)
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data))


def _count_pieces(name: str):
    """The pieces of every distinct word of a bucket, counted once, for each chunk that holds it."""
    def count(table: pa.Table) -> pa.Table:
        lists = [_words(bags.unpack(b)[0], w) for b, w in zip(table["body"].to_pylist(), table["words"].to_pylist())]
        coded = pa.concat_arrays(lists).dictionary_encode()
        tokenizer, pieces = byte_tokenizer(name), []
        for a in range(0, len(coded.dictionary), 4096):
            words = coded.dictionary[a:a + 4096].to_pylist()
            pieces += [len(x) for x in tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        mine = np.array(pieces, dtype=np.int64)[np.asarray(coded.indices)]
        parts = np.split(mine, np.cumsum([len(x) for x in lists])[:-1])
        return pa.table([table["chunk"], table["at"], pa.array([bags.pack(x) for x in parts], pa.binary())], schema=_COUNTS)
    return count


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def _sum(slices: pa.Table, counts: pa.Table) -> pa.Table:
    """Frequencies times pieces, summed per document of a chunk."""
    parts = sorted(zip(counts["at"].to_pylist(), counts["pieces"].to_pylist()))
    pieces = np.concatenate([bags.unpack(p)[0] for _, p in parts] or [np.zeros(0)]).astype(np.int64)
    found: dict[str, list] = {f.name: [] for f in _RESULT}
    for ids, sizes, specials, body in zip(*(slices[c].to_pylist() for c in ("doc_ids", "n_bytes", "specials", "body"))):
        owner, key, weight = bags.read_slice(body)
        found["doc_id"] += ids
        found["n_bytes"] += sizes
        found["n_tokens"] += (bags.sum_by(owner, weight * pieces[key], len(ids)) + np.array(specials)).tolist()
    return pa.table([pa.array(found[f.name], f.type) for f in _RESULT], schema=_RESULT)


def count_tokens(docs: DataFrame, tokenizer: str = BYTE_BPE, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) per row of ``docs``.

    ``tokenizer`` names a public byte-level BPE file or is its path, the same on all machines.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    buckets = bags.bucket_count(texts)
    plain = ~F.rlike("text", F.lit(UNKNOWN))
    for s in special_strings(tokenizer):
        plain &= ~F.contains("text", F.lit(s))
    words = texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                         split_words(F.col("text"), plain).alias("words"), F.when(~plain, F.col("text")).alias("text"))
    chunks = bags.stored(spark, words.mapInArrow(_cut(tokenizer, buckets), _CHUNKS_SQL), "token-chunks")
    counts = (chunks.where(F.col("bucket").isNotNull()).select("chunk", "bucket", "at", "body", "words")
              .groupBy("bucket").applyInArrow(_count_pieces(tokenizer), _COUNTS_SQL))
    slices = chunks.where(F.col("bucket").isNull()).select("chunk", "doc_ids", "n_bytes", "specials", "body")
    sums = slices.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(
        _sum, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return sums.withColumn("over_limit", F.col("n_tokens") > limit)
