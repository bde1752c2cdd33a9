"""Substring dedup by relative Lempel-Ziv parsing, over words.

The blocks that meet under one anchor are parsed in the order of their
documents, each against every block of a smaller document.  The reference is
indexed by its ``span``-word seeds: a seed leads to all its (block, position)
places.  A block is factored greedily from the left: a factor starts at the first
word whose seed has a place in the reference; the match is followed word by word
along each of these sources and the longest one is the factor (word, source
block, position in the source, length).  The words around a factor's end are checked
again: the parse goes on at the first window that crosses the boundary, so a
passage copied half from one source and half from another is found.  All
windows inside factors are duplicates.  A factor that ends with its block is
continued by the document's next block, whose windows are parsed under their own
anchor.  What no factor of ``span`` words covers is literal and stays.

Defined results: a null or empty text has no words and keeps the empty string;
rows without a doc_id come after all others; rows that share a doc_id never
remove anything from each other; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from . import rolling as R
from .repeats import Spec, find_repeats

SPAN = 50
SPEC = Spec("word", SPAN, gram=16)


#: Words of sources compared at a time, so that many sources of one seed need no more memory.
COMPARED = 1 << 20


@dataclass(frozen=True)
class Factor:
    """``length`` words from ``start`` equal those of block ``source`` from ``at``."""

    start: int
    source: int
    at: int
    length: int


def relative_factors(blocks: list[np.ndarray], ids: list[int], span: int) -> list[list[Factor]]:
    """The factors of every block, greedily from the left, against all blocks of smaller ids.

    Blocks come in ascending order of their ids.  Of equally long sources the one of the earliest block counts.
    """
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in blocks])))
    words = np.concatenate(blocks)
    starts, owner = R.windows(bounds, span)
    found: list[list[Factor]] = [[] for _ in blocks]
    if not len(starts):
        return found
    seeds = R.gram_hash(R.gram_sums(words), starts, starts + span)
    places = np.argsort(seeds, kind="stable")  # the places of a seed lie together, by block
    head = np.append(True, seeds[places][1:] != seeds[places][:-1])
    first_place = np.empty(len(seeds), dtype=np.int64)
    first_place[places] = np.flatnonzero(head)[np.cumsum(head) - 1]
    holder = np.asarray(ids)[owner]
    known = np.flatnonzero(holder[places[first_place]] < holder)  # seeds with a place in the reference
    i = 0
    while i < len(known):
        w = known[i]
        block, begin = owner[w], starts[w]
        # the blocks of smaller ids are the first places of the seed
        own = np.searchsorted(holder, holder[w])
        sources = places[first_place[w]:]
        sources = sources[:_same_seed(seeds, sources, seeds[w], own)]
        at, length = longest_source(words, starts[sources], bounds[owner[sources] + 1], begin, bounds[block + 1])
        if length < span:  # another text under the seed's hash
            i += 1
            continue
        source = np.searchsorted(bounds, at, side="right") - 1
        found[block].append(Factor(int(begin - bounds[block]), int(source), int(at - bounds[source]), length))
        i = np.searchsorted(known, w + length - span + 1)
    return found


def _same_seed(seeds: np.ndarray, places: np.ndarray, seed, own: int) -> int:
    """How many of the sorted places hold the seed and come before window ``own``."""
    low, high = 0, len(places)
    while low < high:
        mid = (low + high) // 2
        if seeds[places[mid]] == seed and places[mid] < own:
            low = mid + 1
        else:
            high = mid
    return low


def longest_source(words: np.ndarray, at: np.ndarray, ends: np.ndarray, begin: int, end: int) -> tuple[int, int]:
    """The place in ``at`` from which most words equal those from ``begin`` on, and how many; sources stop at ``ends``."""
    mine, best = words[begin:end], (0, 0)
    step = max(COMPARED // len(mine), 1)
    for a in range(0, len(at), step):
        some = at[a:a + step]
        grid = some[:, None] + np.arange(len(mine))
        same = (words[np.minimum(grid, len(words) - 1)] == mine) & (grid < ends[a:a + step, None])
        length = np.where(same.all(axis=1), len(mine), same.argmin(axis=1))
        top = int(length.argmax())
        if length[top] > best[1]:
            best = int(some[top]), int(length[top])
    return best


def duplicate_starts(blocks: list[np.ndarray], ids: list[int], span: int, at: list[int]) -> list[np.ndarray]:
    """For each block, the starts of its windows inside factors; ``at``, the anchors' places, is not needed here."""
    return [np.concatenate([np.arange(f.start, f.start + f.length - span + 1) for f in own]) if own
            else np.zeros(0, dtype=np.int64) for own in relative_factors(blocks, ids, span)]


def dedup_substrings(docs: DataFrame, spec: Spec = SPEC) -> DataFrame:
    """doc_id, n_units (words), n_removed, n_spans, spans, kept_sha256 per row of ``docs``."""
    return find_repeats(docs, spec, duplicate_starts)
