"""Repeated passages: which windows of a document also start in an earlier one.

A *window* is ``span`` consecutive units (bytes or words) of one document.  The
search is exact and moves only what can match:

1. In every window the ``gram``-unit slice with the smallest hash is its
   *anchor*.  Equal windows have equal anchors at equal places, so a window can
   repeat only if its anchor occurs in two classes (``groups.census``).
2. Neighbouring windows with the same anchor form a *block*.  Blocks under
   shared anchors meet by anchor; a solver (one per operator) says which windows
   of a block start in a smaller document too.  A block seen before in the same
   group of documents is decided there and not sent again.
3. An anchor held by very many chunks (a licence text in a third of all
   documents) is *busy*: its blocks are cut into single windows that meet by
   their whole content, so only equal windows share a group, and each group of
   documents sends a window once.  Nothing is dropped.
4. The starts found go back to the texts, which are cut where they are stored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rolling as R
from .groups import (by_group, buckets_of, census, find_in, lay_out, public_id, read_census, split_by, with_groups)


@dataclass(frozen=True)
class Spec:
    """unit: "byte" or "word"; span: window length; gram: anchor length."""

    unit: str
    span: int
    gram: int
    busy_from: int = 4096


@dataclass
class Chunk:
    """Units of some documents end to end: values to compare, hash sums, document bounds."""

    row: int
    values: np.ndarray
    sums: np.ndarray
    bounds: np.ndarray

    def hashes(self, unit: str, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (R.byte_hash if unit == "byte" else R.gram_hash)(self.sums, starts, ends)


def read(column, unit: str) -> Iterator[Chunk]:
    for row, buf, offsets in R.chunks(column):
        sums = R.byte_sums(buf)
        if unit == "byte":
            yield Chunk(row, buf, sums, offsets)
        else:
            starts, ends, bounds = R.word_bounds(buf, offsets)
            words = R.byte_hash(sums, starts, ends)
            yield Chunk(row, words, R.gram_sums(words), bounds)


def anchors(chunk: Chunk, spec: Spec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window: its start, its document and its anchor's place; then nothing else
    depends on where the chunk was cut."""
    starts, docs = R.windows(chunk.bounds, spec.span)
    n = max(len(chunk.values) - spec.gram + 1, 0)
    at = np.arange(n)
    grams = chunk.hashes(spec.unit, at, at + spec.gram)
    place = R.sliding_argmin(grams, spec.span - spec.gram + 1)
    return starts, docs, place[starts] if len(starts) else np.zeros(0, dtype=np.int64)


def _keys_of(spec: Spec) -> Callable:
    def keys_of(column):
        for chunk in read(column, spec.unit):
            starts, docs, place = anchors(chunk, spec)
            if not len(starts):
                continue
            new = np.ones(len(place), dtype=bool)
            new[1:] = (place[1:] != place[:-1]) | (docs[1:] != docs[:-1])
            place, docs = place[new], docs[new]
            yield chunk.hashes(spec.unit, place, place + spec.gram), docs
    return keys_of


#: A block under its key: owner (group, smallest id, text key), first unit, units, anchor's place in the block.
BLOCK = np.dtype([("key", "<u8"), ("id", "<i8"), ("h", "<i8"), ("g", "<i4"), ("pos", "<i4"), ("n", "<i4"), ("at", "<i4")])
_SENT = pa.schema([("bucket", pa.int32()), ("g", pa.int32()), ("h", pa.int64()), ("head", pa.binary()), ("body", pa.binary())])
_SENT_SQL = "bucket int, g int, h bigint, head binary, body binary"
_STARTS_SQL = "g int, h bigint, starts binary"


def short_key(column) -> np.ndarray:
    """The first eight bytes of the text keys, as numbers."""
    return np.array([struct.unpack("<q", x.as_py()[:8])[0] for x in column], dtype=np.int64)


def _emit_blocks(spec: Spec, n_buckets: int) -> Callable:
    def emit(texts: pa.Table, lists: pa.Table) -> pa.Table:
        found = {f.name: [] for f in _SENT}
        if not texts.num_rows or not lists.num_rows:
            return pa.table([pa.array([], f.type) for f in _SENT], schema=_SENT)
        texts = texts.sort_by("id")  # an earlier block has the smaller id
        g = int(texts["g"][0].as_py())
        shared, busy = read_census(lists)
        ids, hs = np.asarray(texts["id"]), short_key(texts["h"])
        seen: dict[int, int] = {}  # the first document of a block; equal blocks have equal anchors
        for chunk in read(texts["text"], spec.unit):
            starts, docs, place = anchors(chunk, spec)
            if not len(starts):
                continue
            new = np.ones(len(starts), dtype=bool)
            new[1:] = (place[1:] != place[:-1]) | (docs[1:] != docs[:-1])
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(starts)))
            key = chunk.hashes(spec.unit, place[first], place[first] + spec.gram)
            at = find_in(shared, key)
            keep = at >= 0
            first, size, key, at = first[keep], size[keep], key[keep], at[keep]
            if not len(first):
                continue
            hot = busy[at]
            if hot.any():  # blocks under a busy anchor become single windows
                times = np.where(hot, size, 1)
                block = np.repeat(np.arange(len(first)), times)
                first = first[block] + np.arange(len(block)) - np.repeat(np.cumsum(times) - times, times)
                hot, key = hot[block], key[block]
                size = np.where(hot, 1, size[block])
            begin, end = starts[first], starts[first] + size - 1 + spec.span
            content = chunk.hashes(spec.unit, begin, end)
            key, docs = np.where(hot, content, key), docs[first] + chunk.row
            base = chunk.bounds[docs - chunk.row]
            owner = np.array([seen.setdefault(c, d) for c, d in zip(content.tolist(), docs.tolist())])
            # twice within one document: both places need an answer; equal ids never answer each other
            fresh = (owner == docs) | (ids[owner] >= ids[docs])
            old = np.flatnonzero(~fresh)
            if len(old):
                run, n = docs[old], size[old]
                within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                places = (np.repeat(begin[old] - base[old], n) + within).astype(np.int32)
                edge = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
                stop = np.append(np.cumsum(n)[edge[1:] - 1], len(places))
                for d, a, z in zip(run[edge].tolist(), np.append(0, stop[:-1]).tolist(), stop.tolist()):
                    found["bucket"].append(d % n_buckets)
                    found["g"].append(g)
                    found["h"].append(int(hs[d]))
                    found["head"].append(None)
                    found["body"].append(places[a:z].tobytes())
            pick = np.flatnonzero(fresh)
            head = np.zeros(len(pick), dtype=BLOCK)
            head["key"], head["g"] = key[pick], g
            head["id"], head["h"] = ids[docs[pick]], hs[docs[pick]]
            head["pos"], head["n"] = begin[pick] - base[pick], end[pick] - begin[pick]
            head["at"] = place[first[pick]] - begin[pick]
            for b, where in split_by(buckets_of(key[pick], n_buckets), n_buckets):
                found["bucket"].append(b)
                found["g"].append(g)
                found["h"].append(None)
                found["head"].append(head[where].tobytes())
                found["body"].append(b"".join(chunk.values[begin[i]:end[i]].tobytes() for i in pick[where]))
        return pa.table([pa.array(found[f.name], f.type) for f in _SENT], schema=_SENT)
    return emit


def _solve(spec: Spec, solver: Callable) -> Callable:
    schema = pa.schema([("g", pa.int32()), ("h", pa.int64()), ("starts", pa.binary())])
    kind = np.uint8 if spec.unit == "byte" else np.uint64

    def solve(table: pa.Table) -> pa.Table:
        decided = [x is not None for x in table["h"].to_pylist()]
        done = table.filter(pa.array(decided))
        open_ = table.filter(pa.array([not x for x in decided]))
        out = {"g": done["g"].to_pylist(), "h": done["h"].to_pylist(), "starts": done["body"].to_pylist()}
        head = np.frombuffer(b"".join(open_["head"].to_pylist()), dtype=BLOCK)
        body = np.frombuffer(b"".join(open_["body"].to_pylist()), dtype=kind)
        if len(head):
            ends = np.cumsum(head["n"])
            order = np.lexsort((head["pos"], head["h"], head["id"], head["key"]))
            edges = np.flatnonzero(np.append(True, head["key"][order][1:] != head["key"][order][:-1]))
            hits: dict[tuple[int, int], list[np.ndarray]] = {}
            for a, z in zip(edges, np.append(edges[1:], len(order))):
                if z - a < 2:
                    continue
                group = order[a:z]  # by id, so the first of equal contents has their smallest
                blocks = [body[ends[i] - head["n"][i]:ends[i]] for i in group]
                index: dict[bytes, int] = {}
                which = [index.setdefault(x.tobytes(), len(index)) for x in blocks]
                first = _firsts(which)
                ids = head["id"][group]
                answers = solver([blocks[i] for i in first], ids[first].tolist(), spec.span,
                                 head["at"][group[first]].tolist()) if len(first) > 1 else [()]
                for i, k in zip(range(len(group)), which):
                    starts = answers[k] if ids[i] == ids[first[k]] else range(len(blocks[i]) - spec.span + 1)
                    if len(starts):
                        at = head[group[i]]
                        hits.setdefault((int(at["g"]), int(at["h"])), []).append(
                            np.asarray(starts, dtype=np.int32) + at["pos"])
            for (g, h), parts in hits.items():
                out["g"].append(g)
                out["h"].append(h)
                out["starts"].append(np.concatenate(parts).astype(np.int32).tobytes())
        return pa.table([pa.array(out[f.name], f.type) for f in schema], schema=schema)
    return solve


def _firsts(which: list[int]) -> list[int]:
    first: dict[int, int] = {}
    for i, k in enumerate(which):
        first.setdefault(k, i)
    return list(first.values())


def _cut(spec: Spec) -> Callable:
    """Classes with their removal mask applied: sizes, spans and the digest of what is left."""
    schema = pa.schema([("h", pa.binary()), ("first_id", pa.int64()), ("n_units", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("spans", pa.list_(pa.int64())), ("kept_sha256", pa.string())])

    def cut(texts: pa.Table, found: pa.Table) -> pa.Table:
        out = {f.name: [] for f in schema}
        starts: dict[int, list[bytes]] = {}
        for h, s in zip(found["h"].to_pylist(), found["starts"].to_pylist()):
            starts.setdefault(h, []).append(s)
        full, ids = texts["h"].to_pylist(), texts["id"].to_pylist()
        for row, buf, offsets in R.chunks(texts["text"]) if texts.num_rows else ():
            if spec.unit == "word":
                begin, end, bounds = R.word_bounds(buf, offsets)
                joined, joined_at = join_words(buf, begin, end, bounds)
            else:
                bounds = offsets
            for i in range(len(offsets) - 1):
                h, n = full[row + i], int(bounds[i + 1] - bounds[i])
                mine = starts.get(struct.unpack("<q", h[:8])[0])
                if mine is None:
                    gone = None
                    a = z = np.zeros(0, dtype=np.int64)
                else:
                    gone = R.covered(n, np.frombuffer(b"".join(mine), dtype=np.int32).astype(np.int64), spec.span)
                    a, z = R.runs_of(gone)
                if spec.unit == "byte":
                    text = buf[offsets[i]:offsets[i + 1]]
                    left = text if gone is None else text[~gone]
                    digest = hashlib.sha256(left.tobytes())
                elif gone is None:
                    digest = hashlib.sha256(joined[joined_at[i]:joined_at[i + 1]][:-1].tobytes())
                else:
                    digest = hashlib.sha256(b" ".join(
                        buf[begin[w]:end[w]].tobytes() for w in (np.flatnonzero(~gone) + bounds[i])))
                out["h"].append(h)
                out["first_id"].append(ids[row + i])
                out["n_units"].append(n)
                out["n_removed"].append(int((z - a).sum()))
                out["n_spans"].append(len(a))
                out["spans"].append(np.stack([a, z], axis=1).ravel().tolist())
                out["kept_sha256"].append(digest.hexdigest())
        return pa.table([pa.array(out[f.name], f.type) for f in schema], schema=schema)
    return cut


def join_words(buf, begin, end, bounds) -> tuple[np.ndarray, np.ndarray]:
    """All words, each followed by one space, and where each document's part begins."""
    size = end - begin + 1
    stop = np.cumsum(size)
    out = np.full(int(stop[-1]) if len(stop) else 0, 0x20, dtype=np.uint8)
    inside = np.ones(len(out), dtype=bool)
    inside[stop - 1] = False
    mask = np.zeros(len(buf) + 1, dtype=np.int8)
    mask[begin] += 1
    mask[end] -= 1
    # adjoining words of two documents: the end of one is the start of the next
    out[inside] = buf[np.cumsum(mask[:-1]).astype(bool)] if len(begin) else buf[:0]
    return out, np.concatenate(([0], stop))[bounds]


def find_repeats(docs: DataFrame, spec: Spec, solver: Callable) -> DataFrame:
    """One row per input row: doc_id, n_units, n_removed, n_spans, spans, kept_sha256.

    spans holds begin, end pairs of the removed runs, in units.  A row whose whole
    text stands under a smaller doc_id is removed entirely if it has a window at all.
    """
    layout = lay_out(docs)
    n = 4 * layout.width
    lists = census(layout, _keys_of(spec), spec.busy_from)
    sent = with_groups(layout, lists, _emit_blocks(spec, n), _SENT_SQL)
    starts = sent.groupBy("bucket").applyInArrow(_solve(spec, solver), _STARTS_SQL)
    classes = with_groups(layout, starts, _cut(spec), "h binary, first_id bigint, n_units bigint, n_removed bigint, "
                          "n_spans bigint, spans array<bigint>, kept_sha256 string")
    rows = layout.rows.join(classes, "h")
    copy = (F.col("id") > F.col("first_id")) & (F.col("n_units") >= spec.span)
    return rows.select(
        public_id(F.col("id")).alias("doc_id"), "n_units",
        F.when(copy, F.col("n_units")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
        F.when(copy, F.array(F.lit(0).cast("long"), F.col("n_units"))).otherwise(F.col("spans")).alias("spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"))
