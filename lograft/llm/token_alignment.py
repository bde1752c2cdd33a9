r"""Alignment of two tokenizers' tokens by merge-path partitioning.

Both token sequences of a document cover the same bytes (a space and the text).
Byte offsets where tokens of A and of B both end cut them into groups.

* The ends of A and of B form one merge.  ``merge_path`` finds by a binary search
  on each diagonal how many ends of A and of B lie before it, so the merge is cut
  into *pieces* of ``PIECE`` steps that need nothing of each other.
* ``overlaps`` emits the offsets that A and B share inside a piece.
* A document of one piece is finished where it was tokenized.  The pieces of a
  longer one are rows of their own, dealt out to tasks of equal work; then they
  are stitched: an end of A that is the last step of a piece and an equal end of B
  that is the first of the next are a cut, and the groups that a boundary divides
  are joined.

How many documents hold an A-B pair is counted over the whole corpus: pairs are
keys of ``bags``, so a chunk of documents sends each pair once.

Words (up to a space for B) are tokenized once per batch and their ids are put
together; both tokenizers treat each word for itself.  The bytes of the tokens are
compared with the text's; a text that differs anywhere is tokenized again as a
whole, and has no tokens if it still differs.

Defined results: null and empty texts, and texts whose tokens do not spell them,
have no tokens, zeros and an empty digest; rows without a doc_id and rows that
share one are documents of their own; extra columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bags
from . import rolling as R
from .tokens import (BYTE_BPE, PIECE_BPE, UNKNOWN, byte_tokenizer, own_words, piece_tokenizer, split_words, utf8_parts,
                     word_lists)

#: Merge steps (token ends of A and B) of a piece.
PIECE = 1 << 14
#: Bytes of text that a task tokenizes at a time.
STEP_BYTES = 2 << 20
#: Words whose tokens a worker remembers.
REMEMBERED = 100_000
#: Links of a group above which equal tokens of the group are counted first.
LARGE_GROUP = 4096


# ---- tokens -----------------------------------------------------------------

def _byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Side:
    """One tokenizer: ids of distinct words, and the bytes of each id."""

    def __init__(self, name: str):
        self.memo: dict[str, list[int]] = {}
        self.load(name)
        self.sizes = np.array([len(x) for x in self.spelled], dtype=np.int64)

    def ids(self, words: list[str], often: np.ndarray) -> tuple[list[list[int]], np.ndarray]:
        """Ids of every word, and whether they spell it; words that do and occur ``often`` are remembered for later batches."""
        memo = self.memo
        out: list = [memo.get(w) for w in words]
        unknown = [i for i, x in enumerate(out) if x is None]
        good, room = np.ones(len(words), dtype=bool), REMEMBERED - len(memo)
        for i, found in zip(unknown, self.encode([words[i] for i in unknown])):
            out[i], good[i] = found, self.spells(found, words[i].encode())
            if room > 0 and often[i] and good[i] and len(words[i]) <= 24:
                memo[words[i]] = found
                room -= 1
        return out, good

    def spells(self, ids: list[int], text: bytes) -> bool:
        return b"".join([self.spelled[i] for i in ids]) == text


class ByteSide(Side):
    def load(self, name: str) -> None:
        self.tokenizer, at = byte_tokenizer(name), _byte_characters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.spelled = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.spelled[i] = bytes(at[c] for c in token)

    def encode(self, words: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        for a in range(0, len(words), 8192):
            out += [x.ids for x in self.tokenizer.encode_batch_fast(words[a:a + 8192], add_special_tokens=False)]
        return out

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(" " + text, add_special_tokens=False).ids


class PieceSide(Side):
    def load(self, name: str) -> None:
        self.tokenizer = piece_tokenizer(name)
        self.spelled = []
        for i in range(self.tokenizer.vocab_size()):
            piece = self.tokenizer.id_to_piece(i)
            self.spelled.append(bytes([int(piece[3:5], 16)]) if self.tokenizer.is_byte(i) else piece.replace("▁", " ").encode())
        self.blank = [self.tokenizer.piece_to_id("▁")]

    def encode(self, words: list[str]) -> list[list[int]]:
        """Words begin with the space that the tokenizer adds; it adds none to an empty text."""
        found = self.tokenizer.encode([w[1:] for w in words], num_threads=1)
        return [x or self.blank for x in found]

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text)


@lru_cache(maxsize=2)
def sides(a: str, b: str) -> tuple[ByteSide, PieceSide]:
    return ByteSide(a), PieceSide(b)


def spaced_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Each text with a space before it, cut before every run of spaces; and the text of each word."""
    data, offsets = utf8_parts(pc.binary_join_element_wise(pa.scalar(""), texts, " "))
    space = data == 0x20
    start = space & np.concatenate(([True], ~space[:-1])) if len(data) else space
    start[offsets[:-1]] = True  # no text is empty here: each begins with its space
    begin = np.flatnonzero(start)
    words = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(np.append(begin, len(data)).tobytes()), pa.py_buffer(data.tobytes()))
    return words, np.searchsorted(offsets, begin, side="right") - 1


def tokenize(side: Side, words: pa.Array, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts end to end, the bounds of each text, and whether each text is spelled by its ids."""
    coded = words.dictionary_encode()
    local = np.asarray(coded.indices).astype(np.int64)
    vocabulary = coded.dictionary.to_pylist()
    lists, good = side.ids(vocabulary, np.bincount(local, minlength=len(vocabulary)) > 1)
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    flat = np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(sizes.sum()))
    size = sizes[local]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    ids = flat[np.repeat((np.cumsum(sizes) - sizes)[local] - (ends - size), size) + np.arange(total)]
    bounds = np.concatenate(([0], ends))[np.searchsorted(owner, np.arange(n + 1))]
    spelled = np.ones(n, dtype=bool)
    spelled[owner[~good[local]]] = False
    return ids, bounds, spelled


# ---- merging ----------------------------------------------------------------

def merge_path(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of the ascending ``a`` lie before each diagonal of their merge with ``b``; of equal values ``a`` is first.

    One binary search a diagonal, all of them in step.
    """
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        at, other = np.minimum(middle, len(a) - 1), np.clip(diagonals - 1 - middle, 0, max(len(b) - 1, 0))
        before = a[at] <= b[other]
        low = np.where(open_ & before, middle + 1, low)
        high = np.where(open_ & ~before, middle, high)


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each end of A and of B whether the other side has it too."""
    if not len(a) or not len(b):
        return np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    cut = b[at] == a
    other = np.zeros(len(b), dtype=bool)
    other[at[cut]] = True
    return cut, other


def group_links(ga: np.ndarray, gb: np.ndarray, a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair, links) of all links; ga, gb: the group of each token, ascending; a pair is ``a << 16 | b``."""
    na, nb = np.bincount(ga, minlength=n), np.bincount(gb, minlength=n)
    first_a, first_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    large = na * nb > LARGE_GROUP
    mine = np.flatnonzero(~large[ga])
    times = nb[ga[mine]]
    left = np.repeat(mine, times)
    place = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
    right = first_b[ga[left]] + place
    group, pair, weight = [ga[left]], [a[left] << 16 | b[right]], [np.ones(len(left), dtype=np.int64)]
    for g in np.flatnonzero(large):
        x, nx = np.unique(a[first_a[g]:first_a[g] + na[g]], return_counts=True)
        y, ny = np.unique(b[first_b[g]:first_b[g] + nb[g]], return_counts=True)
        pair.append((x[:, None] << 16 | y[None, :]).ravel())
        weight.append((nx[:, None] * ny[None, :]).ravel())
        group.append(np.full(len(pair[-1]), g))
    return np.concatenate(group), np.concatenate(pair), np.concatenate(weight)


@lru_cache(maxsize=2)
def _labels(size: int, ends: tuple[str, str]) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.array([f"{i}{e}" for i in range(size)], dtype=object) for e in ends)


def spell_groups(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens as text, group by group, A's before B's, and the place of each token of A."""
    ga, gb = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    groups = int(cut_a.sum()) + 1
    before_b = np.concatenate(([0], np.cumsum(np.bincount(gb, minlength=groups))))
    through_a = np.cumsum(np.bincount(ga, minlength=groups))
    out = np.empty(len(a) + len(b), dtype=object)
    at = np.arange(len(a)) + before_b[ga]
    within, last = _labels(1 << 16, (",", "|"))
    out[at] = np.where(cut_a, last[a], within[a])
    within, last = _labels(1 << 16, (",", ";"))
    out[np.arange(len(b)) + through_a[gb]] = np.where(cut_b, last[b], within[b])
    return out, at


class Merged:
    """Merged documents end to end: their cuts, counts, digests and links."""

    def __init__(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, bounds_a: np.ndarray, bounds_b: np.ndarray):
        n = len(bounds_a) - 1
        self.n_a, self.n_b = np.diff(bounds_a), np.diff(bounds_b)
        cuts = np.concatenate(([0], np.cumsum(cut_a)))
        self.n_groups = cuts[bounds_a[1:]] - cuts[bounds_a[:-1]]
        ga, gb, groups = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b, int(cuts[-1])
        doc_of = np.repeat(np.arange(n), self.n_groups)
        links = np.bincount(ga, minlength=groups) * np.bincount(gb, minlength=groups)
        self.n_links = bags.sum_by(doc_of, links, n)
        text, _ = spell_groups(a, b, cut_a, cut_b)
        edges = bounds_a + bounds_b
        self.digests = [hashlib.sha256("".join(text[x:z].tolist())[:-1].encode()).hexdigest() if z > x else ""
                        for x, z in zip(edges.tolist(), edges[1:].tolist())]
        group, pair, weight = group_links(ga, gb, a, b, groups)
        self.vocabulary, local = np.unique(pair, return_inverse=True)
        self.owner, self.key, self.weight = bags.count_up(doc_of[group], local, weight, len(self.vocabulary))


# ---- Spark ------------------------------------------------------------------

_ALIGNED_SQL = ("chunk bigint, bucket int, at int, doc_ids array<bigint>, counts array<bigint>, digests array<string>, body binary, "
                "document bigint, piece int, a binary, b binary, a_from bigint, b_from bigint")
_ALIGNED = pa.schema([
    ("chunk", pa.int64()), ("bucket", pa.int32()), ("at", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
    ("digests", pa.list_(pa.string())), ("body", pa.binary()), ("document", pa.int64()), ("piece", pa.int32()), ("a", pa.binary()),
    ("b", pa.binary()), ("a_from", pa.int64()), ("b_from", pa.int64())])


class Rows:
    """Rows of ``_ALIGNED``: slices of documents, slices of a chunk's pairs, and pieces of long documents."""

    def __init__(self):
        self.found = {f.name: [] for f in _ALIGNED}

    def add(self, **row) -> None:
        for column in self.found:
            self.found[column].append(row.get(column))

    def chunk(self, chunk: int, doc_ids: list, merged: Merged, buckets: int) -> None:
        pairs = merged.vocabulary
        bucket = (R.mix(pairs.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        owner, key, weight = bags.count_up(merged.owner, rank[merged.key], merged.weight, len(pairs))
        counts = np.stack([merged.n_a, merged.n_b, merged.n_groups, merged.n_links], axis=1)
        for a, z, body in bags.slices(len(doc_ids), owner, key, weight):
            self.add(chunk=chunk, doc_ids=doc_ids[a:z], counts=counts[a:z].ravel().tolist(), digests=merged.digests[a:z], body=body)
        holders = np.bincount(key, minlength=len(pairs))
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for k in np.flatnonzero(np.diff(edges)):
            mine = slice(edges[k], edges[k + 1])
            self.add(chunk=chunk, bucket=int(k), at=int(edges[k]), body=bags.pack(pairs[order][mine], holders[mine]))

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.found[f.name], f.type) for f in _ALIGNED], schema=_ALIGNED)


def _token_batch(batch: pa.RecordBatch, a: ByteSide, b: PieceSide) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, bounds) of both sides for texts that are not empty; no tokens where they do not spell the text."""
    n, texts = batch.num_rows, batch["text"]
    others = {int(r): own_words(a.tokenizer, " " + texts[int(r)].as_py()) for r in np.flatnonzero(np.asarray(batch["words"].is_null()))}
    made = [tokenize(a, *word_lists(batch["words"], others), n), tokenize(b, *spaced_words(texts), n)]
    wrong = np.flatnonzero(~(made[0][2] & made[1][2]))
    if not len(wrong):
        return [(ids, bounds) for ids, bounds, _ in made]
    again = {}
    for r in wrong.tolist():
        text = texts[r].as_py()
        whole = [side.whole(text) for side in (a, b)]
        good = all(side.spells(x, b" " + text.encode()) for side, x in zip((a, b), whole))
        again[r] = whole if good else ([], [])
    out = []
    for k, (ids, bounds, _) in enumerate(made):
        parts = [np.array(again[r][k], dtype=np.int64) if r in again else ids[bounds[r]:bounds[r + 1]] for r in range(n)]
        out.append((np.concatenate(parts), np.concatenate(([0], np.cumsum([len(x) for x in parts])))))
    return out


def _select(ids: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keep = np.repeat(rows, np.diff(bounds))
    return ids[keep], np.concatenate(([0], np.cumsum(np.diff(bounds)[rows])))


def _align(name_a: str, name_b: str, buckets: int, piece: int):
    """Arrow batches of (doc_id, words, text) as rows of ``_ALIGNED``."""
    def align(batches):
        a, b = sides(name_a, name_b)
        chunk = long_ones = 0
        for batch in batches:
            size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch["text"]), 0)).astype(np.int64))
            part = size // STEP_BYTES
            edges = np.flatnonzero(np.append(True, part[1:] != part[:-1])).tolist() if len(part) else []
            for x, z in zip(edges, [*edges[1:], batch.num_rows]):
                rows, n = _align_step(batch.slice(x, z - x), a, b, bags.chunk_number(chunk), buckets, piece, bags.chunk_number(long_ones))
                chunk, long_ones = chunk + 1, long_ones + n
                yield rows
    return align


def _align_step(batch: pa.RecordBatch, a: ByteSide, b: PieceSide, chunk: int, buckets: int, piece: int,
                document: int) -> tuple[pa.RecordBatch, int]:
    """Rows of one chunk and how many long documents it has; they are numbered from ``document``."""
    rows, doc_ids = Rows(), np.array(batch["doc_id"].to_pylist(), dtype=object)
    full = np.asarray(pc.greater(pc.fill_null(pc.binary_length(batch["text"]), 0), 0)).astype(bool)
    n = batch.num_rows
    size = np.zeros((2, n), dtype=np.int64)
    ids = [np.zeros(0, dtype=np.int64)] * 2
    if full.any():
        made = _token_batch(batch.filter(pa.array(full)), a, b)
        for k, (found, bounds) in enumerate(made):
            ids[k], size[k, full] = found, np.diff(bounds)
    bounds = [np.concatenate(([0], np.cumsum(x))) for x in size]
    ends = [np.cumsum(side.sizes[x]) for side, x in zip((a, b), ids)]
    long_ = size.sum(axis=0) > piece
    if long_.any():
        begin = bounds[0] + bounds[1]
        for number, row in enumerate(np.flatnonzero(long_).tolist(), document):
            diagonals = np.append(np.arange(begin[row], begin[row + 1], piece), begin[row + 1])
            at_a = merge_path(*ends, diagonals)
            at_b = diagonals - at_a
            base = int(ends[0][at_a[0] - 1]) if at_a[0] else 0
            for k, (x, z, y, w) in enumerate(zip(at_a, at_a[1:], at_b, at_b[1:])):
                rows.add(document=number, piece=k, doc_ids=[doc_ids[row]], a=ids[0][x:z].astype("<u2").tobytes(),
                         b=ids[1][y:w].astype("<u2").tobytes(), a_from=(int(ends[0][x - 1]) if x else 0) - base,
                         b_from=(int(ends[1][y - 1]) if y else 0) - base)
    short = ~long_
    whole = [_select(x, y, short) for x, y in zip(ids, bounds)]
    cuts = overlaps(*(np.cumsum(side.sizes[x]) for side, (x, _) in zip((a, b), whole)))
    merged = Merged(whole[0][0], whole[1][0], *cuts, whole[0][1], whole[1][1])
    rows.chunk(chunk, doc_ids[short].tolist(), merged, buckets)
    return rows.batch(), int(long_.sum())


_PIECE_SQL = "document bigint, piece int, doc_id bigint, a binary, b binary, cut_a binary, cut_b binary, first_b bigint, last_a bigint"
_PIECE = pa.schema([("document", pa.int64()), ("piece", pa.int32()), ("doc_id", pa.int64()), ("a", pa.binary()), ("b", pa.binary()),
                    ("cut_a", pa.binary()), ("cut_b", pa.binary()), ("first_b", pa.int64()), ("last_a", pa.int64())])


def _overlap_pieces(name_a: str, name_b: str):
    """Every piece for itself: the cuts inside it, and the two ends that may meet those of its neighbours."""
    def find(batches):
        a, b = sides(name_a, name_b)
        for batch in batches:
            found = {f.name: [] for f in _PIECE}
            for row in batch.to_pylist():
                x, y = (np.frombuffer(row[c], dtype="<u2").astype(np.int64) for c in ("a", "b"))
                ends_a, ends_b = np.cumsum(a.sizes[x]) + row["a_from"], np.cumsum(b.sizes[y]) + row["b_from"]
                cut_a, cut_b = overlaps(ends_a, ends_b)
                values = (row["document"], row["piece"], row["doc_ids"][0], row["a"], row["b"], cut_a.tobytes(), cut_b.tobytes(),
                          int(ends_b[0]) if len(y) else None, int(ends_a[-1]) if len(x) else None)
                for column, value in zip(found, values):
                    found[column].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in _PIECE], schema=_PIECE)
    return find


def _stitch(buckets: int):
    """The pieces of one document, joined: a chunk of its own."""
    def stitch(table: pa.Table) -> pa.Table:
        pieces = table.sort_by("piece").to_pylist()
        a, b = (np.concatenate([np.frombuffer(p[c], dtype="<u2") for p in pieces]).astype(np.int64) for c in ("a", "b"))
        cuts = {c: [np.frombuffer(p[c], dtype=bool).copy() for p in pieces] for c in ("cut_a", "cut_b")}
        for k in range(1, len(pieces)):
            if pieces[k - 1]["last_a"] is not None and pieces[k - 1]["last_a"] == pieces[k]["first_b"]:
                cuts["cut_a"][k - 1][-1] = cuts["cut_b"][k][0] = True
        merged = Merged(a, b, np.concatenate(cuts["cut_a"]), np.concatenate(cuts["cut_b"]), np.array([0, len(a)]), np.array([0, len(b)]))
        rows = Rows()
        rows.chunk(-1 - pieces[0]["document"], [pieces[0]["doc_id"]], merged, buckets)
        return pa.Table.from_batches([rows.batch()])
    return stitch


_TOTALS_SQL = "chunk bigint, at int, body binary"
_TOTALS = pa.schema([("chunk", pa.int64()), ("at", pa.int32()), ("body", pa.binary())])


def _total(table: pa.Table) -> pa.Table:
    """Documents that hold each pair of a bucket, for every chunk that has it."""
    lists = [bags.unpack(x) for x in table["body"].to_pylist()]
    pairs = np.concatenate([x[0] for x in lists])
    distinct, inverse = np.unique(pairs, return_inverse=True)
    total = np.zeros(len(distinct), dtype=np.int64)
    np.add.at(total, inverse, np.concatenate([x[1] for x in lists]).astype(np.int64))
    mine = np.split(total[inverse], np.cumsum([len(x[0]) for x in lists])[:-1])
    body = [bags.pack(x[0], t) for x, t in zip(lists, mine)]
    return pa.table([table["chunk"], table["at"], pa.array(body, pa.binary())], schema=_TOTALS)


def _highest(batches):
    """The highest count of every A id in a batch."""
    for batch in batches:
        top = np.zeros(1 << 16, dtype=np.int64)
        for value in batch["body"].to_pylist():
            pairs, total = bags.unpack(value)
            np.maximum.at(top, pairs >> 16, total.astype(np.int64))
        seen = np.flatnonzero(top)
        yield pa.RecordBatch.from_pydict({"a": pa.array(seen, pa.int32()), "top": pa.array(top[seen], pa.int64())})


_RESULT = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
                     ("groups_sha256", pa.string())])
_RESULT_SQL = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
               "groups_sha256 string")


def _sum(top: np.ndarray):
    """Links times counts, and links of highest count, per document of a chunk."""
    def sums(slices: pa.Table, totals: pa.Table) -> pa.Table:
        parts = [bags.unpack(x) for _, x in sorted(zip(totals["at"].to_pylist(), totals["body"].to_pylist()))]
        pairs = np.concatenate([p for p, _ in parts] or [np.zeros(0)]).astype(np.int64)
        total = np.concatenate([t for _, t in parts] or [np.zeros(0)]).astype(np.int64)
        best = total == top[pairs >> 16]
        found: dict[str, list] = {f.name: [] for f in _RESULT}
        for ids, counts, digests, body in zip(*(slices[c].to_pylist() for c in ("doc_ids", "counts", "digests", "body"))):
            owner, key, weight = bags.read_slice(body)
            found["doc_id"] += ids
            found["groups_sha256"] += digests
            for k, column in enumerate(("n_a", "n_b", "n_groups", "n_links")):
                found[column] += counts[k::4]
            found["count_sum"] += bags.sum_by(owner, weight * total[key], len(ids)).tolist()
            found["n_best"] += bags.sum_by(owner, weight * best[key], len(ids)).tolist()
        return pa.table([pa.array(found[f.name], f.type) for f in _RESULT], schema=_RESULT)
    return sums


def align(docs: DataFrame, tokenizer_a: str = BYTE_BPE, tokenizer_b: str = PIECE_BPE, piece: int = PIECE) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per row of ``docs``.

    The tokenizers are names of public files or paths, the same on all machines: a
    byte-level BPE and a sentencepiece model that adds a space, of at most 65,536 ids each.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    buckets = bags.bucket_count(texts)
    plain = ~F.rlike("text", F.lit(UNKNOWN))
    words = texts.select("doc_id", split_words(F.concat(F.lit(" "), "text"), plain).alias("words"), "text")
    first = bags.stored(spark, words.mapInArrow(_align(tokenizer_a, tokenizer_b, buckets, piece), _ALIGNED_SQL), "aligned")
    pieces = (first.where(F.col("document").isNotNull()).select("document", "piece", "doc_ids", "a", "b", "a_from", "b_from")
              .repartition("document", "piece").mapInArrow(_overlap_pieces(tokenizer_a, tokenizer_b), _PIECE_SQL))
    long_ = bags.stored(spark, pieces.groupBy("document").applyInArrow(_stitch(buckets), _ALIGNED_SQL), "stitched")
    rows = first.where(F.col("document").isNull()).unionByName(long_)
    totals = bags.stored(spark, rows.where(F.col("bucket").isNotNull()).select("chunk", "bucket", "at", "body")
                         .groupBy("bucket").applyInArrow(_total, _TOTALS_SQL), "pair-totals")
    top = np.zeros(1 << 16, dtype=np.int64)  # one number for each id of A, however large the corpus
    for row in totals.select("body").mapInArrow(_highest, "a int, top bigint").groupBy("a").agg(F.max("top").alias("top")).collect():
        top[row.a] = row.top
    slices = rows.where(F.col("bucket").isNull()).select("chunk", "doc_ids", "counts", "digests", "body")
    return slices.groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInArrow(_sum(top), _RESULT_SQL)
