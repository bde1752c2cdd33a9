"""The methods themselves, each against a plain version: factors of the parse, prices of bins."""

import numpy as np
import pytest

from lograft.llm import packing, substring_dedup


def plain_factors(blocks, ids, span):
    """Try every source at every word."""
    out = []
    for b, mine in enumerate(blocks):
        factors, i = [], 0
        while i + span <= len(mine):
            best = (0, 0, 0)
            for s, source in enumerate(blocks):
                if ids[s] < ids[b]:
                    for p in range(len(source)):
                        n = 0
                        while i + n < len(mine) and p + n < len(source) and mine[i + n] == source[p + n]:
                            n += 1
                        if n > best[0]:
                            best = (n, s, p)
            if best[0] >= span:
                factors.append(substring_dedup.Factor(i, best[1], best[2], best[0]))
                i += best[0] - span + 1
            else:
                i += 1
        out.append(factors)
    return out


@pytest.mark.parametrize("compared", [1 << 20, 1])
def test_factors_equal_a_plain_greedy_parse(monkeypatch, compared):
    monkeypatch.setattr(substring_dedup, "COMPARED", compared)
    pick = np.random.default_rng(11)
    seen = 0
    for _ in range(300):
        span = int(pick.integers(1, 5))
        blocks = [pick.integers(0, 3, pick.integers(span, 16)).astype(np.uint64) for _ in range(pick.integers(1, 6))]
        ids = np.sort(pick.integers(0, 4, len(blocks))).tolist()
        plain = plain_factors(blocks, ids, span)
        assert substring_dedup.relative_factors(blocks, ids, span) == plain
        seen += sum(map(len, plain))
        for b, starts in enumerate(substring_dedup.duplicate_starts(blocks, ids, span, [])):
            seeds = {s[i:i + span].tobytes() for s, k in zip(blocks, ids) if k < ids[b] for i in range(len(s) - span + 1)}
            assert starts.tolist() == [i for i in range(len(blocks[b]) - span + 1) if blocks[b][i:i + span].tobytes() in seeds]
    assert seen > 500


def test_a_factor_names_its_longest_source_and_a_boundary_is_checked():
    a, b = np.arange(10, dtype=np.uint64), np.arange(6, 20, dtype=np.uint64)
    mixed = np.arange(2, 18, dtype=np.uint64)  # 2..9 stands in the first, 6..17 in the second
    first, second = substring_dedup.relative_factors([a, b, mixed], [1, 2, 3], 4)[2]
    assert (first.start, first.source, first.at, first.length) == (0, 0, 2, 8)
    # the first window that crosses the end of the first factor starts at the word 7
    assert (second.start, second.source, second.at, second.length) == (5, 1, 1, 11)


def _cost(final):
    return sum(map(packing.bin_cost, final))


def test_lengths_compete_from_the_first_bins_on():
    pick = np.random.default_rng(3)
    sizes = sorted((int(min(max(x, 1), 4096)) for x in pick.lognormal(5.5, 1.2, 8000)), reverse=True)
    where, offset, final, opened = packing.best_fit(sizes)
    # pieces up to the last tenth of all tokens, and the bins opened for them
    upto = np.searchsorted(np.cumsum(sizes), 0.9 * sum(sizes))
    early = [opened[b] for b in set(where[:upto])]
    assert min(early.count(c) for c in packing.LENGTHS) > 200
    assert sum(sizes) / sum(final) > 0.95
    # one length with the same cutting down at the end costs more
    one, _, _, _ = packing.best_fit(sizes, lengths=(4096,))
    used = np.bincount(one, weights=sizes)
    assert _cost(final) < 0.9 * _cost([min(c for c in packing.LENGTHS if c >= u) for u in used])


def plain_best_fit(sizes):
    """The same rules with lists."""
    bins, opened = [], []
    for i, n in enumerate(sizes):
        fitting = [(free, -b) for b, (free, _) in enumerate(bins) if free >= n]
        if fitting:
            tightest = min(fitting)[0]
            # among equals, the bin whose free space came to be last
            b = max((b for b, (free, _) in enumerate(bins) if free == tightest), key=lambda b: bins[b][1])
        else:
            prices = []
            for c in packing.LENGTHS:
                if c >= n:
                    space = c - n
                    for m in sizes[i + 1:]:
                        if m <= space:
                            space -= m
                    prices.append((packing.bin_cost(c) / (c - space), c))
            b = len(bins)
            bins.append((min(prices)[1], i))
            opened.append(min(prices)[1])
        bins[b] = (bins[b][0] - n, i)
        yield b, opened[b]


def test_best_fit_equals_the_rules_written_with_lists():
    pick = np.random.default_rng(8)
    for _ in range(40):
        sizes = sorted(pick.choice([30, 200, 511, 512, 513, 700, 1500, 2048, 4096, int(pick.integers(1, 4097))],
                                   int(pick.integers(1, 60))).tolist(), reverse=True)
        where, offset, final, opened = packing.best_fit(sizes)
        assert list(zip(where, (opened[b] for b in where))) == list(plain_best_fit(sizes))


def test_few_pieces_cost_little_more_than_the_best_assignment():
    def best(sizes, bins):
        if not sizes:
            return _cost([min(c for c in packing.LENGTHS if c >= u) for u in bins])
        n, rest = sizes[0], sizes[1:]
        tries = [best(rest, [*bins[:i], u + n, *bins[i + 1:]]) for i, u in enumerate(bins) if u + n <= 4096]
        return min([*tries, best(rest, [*bins, n])])

    pick = np.random.default_rng(4)
    ratios = []
    for _ in range(60):
        sizes = sorted((int(min(max(x, 1), 4096)) for x in pick.lognormal(6, 1, 6)), reverse=True)
        ratios.append(_cost(packing.best_fit(sizes)[2]) / best(sizes, []))
    assert min(ratios) >= 1 - 1e-9 and np.mean(ratios) < 1.1 and max(ratios) < 1.6
