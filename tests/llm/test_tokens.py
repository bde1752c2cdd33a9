"""Token counts, token alignment and the Merkle manifest against their plain versions."""

import random
from collections import Counter

import numpy as np
import pytest

from lograft.llm import bags, merkle, token_alignment, token_counts, tokens

from . import plain_tokens as plain
from .conftest import frame, make_rows

ODD = ["a <|endoftext|> b <s> </s> <0x41> <unk>", "<|endoftext|><|endoftext|>", "x ՘ y࢏  z", "　　a    b's 12² ",
       " ", "   ", " a ", "x▁y z", "".join(map(chr, range(1, 700))), "\x00a b\x00", "ﬁ é 漢字かな 🙂 ", "漢字" * 4000, "a" * 30000,
       "".join(chr(0x4E00 + i * 7 % 20000) for i in range(9000)), "\r\n\t x\r\n"]


def got(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def texts():
    return make_rows() + list(enumerate(ODD, 9001))


def test_token_counts(spark, texts):
    assert got(token_counts.count_tokens(frame(spark, texts).repartition(3))) == Counter(plain.counts(texts))


def test_token_counts_of_nothing(nothing):
    assert token_counts.count_tokens(nothing).collect() == []


@pytest.mark.parametrize("piece", [token_alignment.PIECE, 37])
def test_alignment(spark, texts, piece):
    assert got(token_alignment.align(frame(spark, texts).repartition(3), piece=piece)) == Counter(plain.alignment(texts))


def test_alignment_of_nothing(nothing):
    assert token_alignment.align(nothing).collect() == []


def test_merge_path_cuts_the_merge():
    pick = np.random.default_rng(3)
    for _ in range(60):
        a, b = (np.unique(pick.integers(0, 200, pick.integers(0, 80))) for _ in "ab")
        merge = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
        diagonals = np.arange(len(merge) + 1)
        want = [sum(side == 0 for _, side in merge[:d]) for d in diagonals]
        assert token_alignment.merge_path(a, b, diagonals).tolist() == want


def test_large_groups_count_the_same_links(monkeypatch):
    a, b = np.array([5, 5, 7, 9, 5]), np.array([1, 2, 1, 3])
    groups = np.array([0, 0, 0, 0, 1]), np.array([0, 0, 0, 1])

    def links():
        found: Counter = Counter()
        for g, pair, n in zip(*(x.tolist() for x in token_alignment.group_links(*groups, a, b, 2))):
            found[g, pair] += n
        return found
    want = links()
    monkeypatch.setattr(token_alignment, "LARGE_GROUP", 2)
    assert links() == want and sum(want.values()) == 13


def test_word_classes_agree_with_the_tokenizer(spark):
    """Every code point that the JVM knows falls into the same class in both word expressions."""
    tokenizer = tokens.byte_tokenizer(tokens.BYTE_BPE)
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    rows = spark.createDataFrame([("".join(f"a{chr(c)}1!{chr(c)}! " for c in points[i:i + 1024]),) for i in range(0, len(points), 1024)], "t string")
    from pyspark.sql import functions as F
    known = rows.select(F.regexp_replace("t", "a[" + tokens.UNKNOWN + "]1![" + tokens.UNKNOWN + "]! ", "").alias("t"))
    for t, words in known.select("t", tokens.split_words(F.col("t"), F.lit(True))).collect():
        assert words == tokens.own_words(tokenizer, t)


def test_packed_numbers():
    wide = [np.array([1, 2, 1 << 40]), np.zeros(0, dtype=np.int64), np.array([7, 8])]
    assert [x.tolist() for x in bags.unpack(bags.pack(*wide))] == [x.tolist() for x in wide]
    owner, key, weight = np.array([0, 0, 2, 2, 2]), np.array([3, 9, 0, 4, 5]), np.array([1, 2, 3, 4, 5])
    (_, _, body), = bags.slices(4, owner, key, weight)
    assert [x.tolist() for x in bags.read_slice(body)] == [owner.tolist(), key.tolist(), weight.tolist()]


MERKLE = "doc_id long, source string, lang string, n_chars int, text string, rank int, digest string, tree string, block long"


def manifest(spark, rows):
    return got(merkle.manifest(spark.createDataFrame([(*r, 1, "d", "t", 2) for r in rows], MERKLE).repartition(3)))


def test_merkle_manifest(spark):
    pick = random.Random(1)
    rows = [(pick.randrange(10 ** 6), pick.choice([None, "a", "é", "b", "b", "b", "", *"xyz"]), pick.choice([None, "en"]),
             pick.choice([None, 5]), pick.choice([None, "", "a\nb", "q\n\n", "z"])) for _ in range(1500)]
    rows += [rows[0]] * 30 + [(None, "b", "x", 1, "t\n")] * 3 + [(7, "solo", None, None, "1\n")]
    found = manifest(spark, rows)
    assert found == Counter(plain.merkle(rows)) and any(not r[-1] for r in found)


@pytest.mark.parametrize("rows", [[], [(2, None, None, None, None)], [(i, f"s{i}", None, 1, "a\n") for i in range(800)]],
                         ids=["none", "one", "sources"])
def test_merkle_manifest_small(spark, rows):
    assert manifest(spark, rows) == Counter(plain.merkle(rows))
