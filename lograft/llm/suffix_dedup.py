"""Substring dedup over bytes with a suffix array built by linear grouping.

``suffix_order`` sorts all suffixes of a short sequence in two passes that never
rename symbols and never recurse:

* Grouping.  Suffixes start in one group per first symbol.  Groups are taken in
  descending order.  Each suffix of the group hands itself to its previous
  smaller suffix (the nearest suffix to the left in a lower group), whose known
  Lyndon prefix thereby grows; suffixes that received equally many form a new
  group directly above their old one.  In the end a group holds the suffixes
  with one common Lyndon prefix and the groups are in lexicographic order.
* Emission.  Reading the final order from its start, every suffix places those
  whose Lyndon prefix ends where it begins at the next free place of their
  group; these are found by following the previous-smaller pointers.

The suffix array is built over the blocks that share an anchor, each cut to what it
can share with another.  Runs of
neighbouring suffixes with ``span`` common bytes hold the occurrences of one
string; all but those of the smallest document are duplicates.

Defined results: a null or empty text has no bytes and keeps the empty string;
rows without a doc_id come after all others; rows that share a doc_id never
remove anything from each other; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .repeats import Spec, find_repeats

SPAN = 50
SPEC = Spec("byte", SPAN, gram=24)


def lyndon_groups(symbols: list[int]) -> tuple[list[list[int]], list[int]]:
    """Suffixes grouped by longest Lyndon prefix, groups ascending, and every previous smaller suffix (-1: none)."""
    n = len(symbols)
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(symbols):
        by_symbol.setdefault(c, []).append(i)
    members = [by_symbol[c] for c in sorted(by_symbol)]
    group = [0] * n
    for k, own in enumerate(members):
        for i in own:
            group[i] = k
    lower = list(range(-1, len(members) - 1))  # neighbours in the order of the groups
    upper = [*range(1, len(members)), -1]
    done, smaller = [False] * n, [-1] * n
    finished: list[list[int]] = []
    k = len(members) - 1
    while k >= 0:
        own = [i for i in members[k] if group[i] == k]  # some may have moved up meanwhile
        if own:
            finished.append(own)
            for i in own:
                done[i] = True
            received: dict[int, int] = {}
            for i in own:
                j = i - 1
                while j >= 0 and done[j]:
                    j = smaller[j]
                smaller[i] = j
                if j >= 0:
                    received[j] = received.get(j, 0) + 1
            moves: dict[tuple[int, int], list[int]] = {}
            for j, times in received.items():
                moves.setdefault((group[j], -times), []).append(j)
            for old, times in sorted(moves):  # the most received goes highest: each is put directly above the old group
                new, over = len(members), upper[old]
                moved = sorted(moves[old, times])
                members.append(moved)
                lower.append(old)
                upper.append(over)
                upper[old] = new
                if over >= 0:
                    lower[over] = new
                for j in moved:
                    group[j] = new
        k = lower[k]
    return finished[::-1], smaller


def suffix_order(symbols: list[int]) -> list[int]:
    """Starts of all suffixes in lexicographic order; a proper prefix sorts first."""
    groups, smaller = lyndon_groups(symbols)
    n = len(symbols)
    order, placed, group, free, at = [0] * n, [False] * n, [0] * n, [], 0
    for k, own in enumerate(groups):
        free.append(at)  # the group's next free place
        at += len(own)
        for i in own:
            group[i] = k
    for r in range(-1, n):
        j = (order[r] if r >= 0 else n) - 1
        while j >= 0 and not placed[j]:
            order[free[group[j]]] = j
            free[group[j]] += 1
            placed[j] = True
            j = smaller[j]
    return order


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def reach(sides: list[bytes]) -> list[int]:
    """For each string, the longest prefix that it shares with another of them."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    out = [0] * len(sides)
    for i, j in zip(order, order[1:]):
        n = common_prefix(sides[i], sides[j])
        out[i], out[j] = max(out[i], n), max(out[j], n)
    return out


def shared_strings(blocks: list[np.ndarray], ids: list[int], span: int, at: list[int]) -> list[np.ndarray]:
    """For each block, the starts of ``span``-byte strings that a block of a smaller id holds.

    Every string of a block covers the block's anchor, so outside the longest stretch that
    the block shares with another one around their anchors nothing can be shared.
    """
    texts = [x.tobytes() for x in blocks]
    right = reach([x[a:] for x, a in zip(texts, at)])
    left = reach([x[:a][::-1] for x, a in zip(texts, at)])
    near = [i for i in range(len(blocks)) if left[i] + right[i] >= span]
    out = [np.zeros(0, dtype=np.int64)] * len(blocks)
    if len(near) < 2:
        return out
    # cut like this, most blocks of a group are equal again; the first of equal ones has their smallest id
    which: dict[bytes, int] = {}
    cuts = [texts[i][at[i] - left[i]:at[i] + right[i]] for i in near]
    kind = [which.setdefault(x, len(which)) for x in cuts]
    least: dict[int, int] = {}
    for i, k in zip(near, kind):
        least[k] = min(ids[i], least.get(k, ids[i]))
    found = _shared([np.frombuffer(x, dtype=np.uint8) for x in which], [least[k] for k in range(len(which))], span) \
        if len(which) > 1 else [out[0]]
    for i, k, x in zip(near, kind, cuts):
        starts = found[k] if ids[i] == least[k] else np.arange(len(x) - span + 1)
        out[i] = starts + at[i] - left[i]
    return out


def _shared(blocks: list[np.ndarray], ids: list[int], span: int) -> list[np.ndarray]:
    sizes = np.array([len(x) for x in blocks])
    ends = np.cumsum(sizes + 1)
    text = np.full(int(ends[-1]), -1, dtype=np.int32)
    block = np.repeat(np.arange(len(blocks)), sizes + 1)
    begin = ends - sizes - 1
    for a, z, x in zip(begin, ends, blocks):
        text[a:z - 1] = x
    text[ends - 1] = -1 - np.arange(len(blocks))  # no two ends are equal, so no string crosses one
    order = np.array(suffix_order(text.tolist()))
    order = order[ends[block[order]] - 1 - order >= span]
    strings = np.lib.stride_tricks.sliding_window_view(text, span)
    new = np.ones(len(order), dtype=bool)
    new[1:] = (strings[order[1:]] != strings[order[:-1]]).any(axis=1)
    owner = np.asarray(ids)[block[order]]
    least = np.minimum.reduceat(owner, np.flatnonzero(new))[np.cumsum(new) - 1]
    hit = order[owner > least]
    return [np.sort(hit[block[hit] == i] - begin[i]) for i in range(len(blocks))]


def dedup_bytes(docs: DataFrame, spec: Spec = SPEC) -> DataFrame:
    """doc_id, n_units (bytes), n_removed, n_spans, spans, kept_sha256 per row of ``docs``."""
    return find_repeats(docs, spec, shared_strings)
