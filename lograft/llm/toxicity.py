"""Toxicity by noisy-channel deobfuscation.

1. A character trigram model is counted over every document.
2. Words that may be disguised (letters swapped for look-alike signs, letters
   spelled one by one, letters repeated) become a lattice: each sign may stand
   for its letters or for nothing, a repeated letter for one or more.  Viterbi
   decoding under the trigram model picks the likeliest plain word.  In a run of
   letters spelled one by one, of any length, each gap may also end a word; chains
   joined by dots, hyphens or underscores count by their parts too.
3. The restored words, and their beginnings and endings, are the features.  From
   labelled rows whose crc32(doc_id) mod 5 is not 0 indicators are
   chosen: first all those that stand in several unrelated toxic documents (told apart
   by the smallest hash of their words, which copies share), then greedily those
   that mark ``MIN_DOCS`` or more toxic documents that none before marks.  Words that
   merely stand in copies of one toxic document do not enter.
4. A regularised logistic model of the number of indicators found gives the score.

At most ``SAMPLE`` labelled rows (those with the smallest hashes of their ids) are
used to learn; the character model and the scores cover all documents.

Defined results: a null or empty text is scored like a text without indicators;
without labelled rows of both kinds every score is 0; label rows with nulls are
not used; a null doc_id counts as not held out and is never learned from; rows
that share a doc_id are scored each; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict
from heapq import heapify, heappop, heapreplace
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rolling as R

SAMPLE = 20_000
HELD = 200_000  # features counted in one task before they are handed on
MIN_DOCS, MIN_PRECISION = 3, 0.97
FAMILIES = 8  # unrelated toxic documents that make an indicator of their own
READINGS = 5  # readings kept of a disguised word
REMEMBERED = 64  # readings of longer runs are not kept for the next time
#: What a sign may stand for.  Fixed values.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou", "#": "h",
              "%": "", "&": "", "^": "", "~": "", "=": "", ".": "", "-": "", "_": "", "'": "", "’": ""}
_SIGNS = re.escape("".join(LOOKALIKES))
_EDGES = " \t\n\x0b\x0c\r.,;:!?\"'()[]{}<>|*#%&$~^=_-+/\\«»“”„¿¡…"
_SPELLED = re.compile(rf"(?<!\w)(?:[^\W_]|[@$!€£|])(?:[ .\-_*]{{1,2}}(?:[^\W_]|[@$!€£|])){{3,}}(?!\w)")
_GAP, _JOINED = re.compile(r"[ .\-_*]{1,2}"), re.compile(r"[.\-_]+")
NARROW, WIDE = "\x01", "\x02"  # gaps of a spelled run
_GAPS = {NARROW: (-1.0, 0.0), WIDE: (-0.1, -4.6)}  # what it costs that a gap ends a word, and that it does not
_THRICE = re.compile(r"(\w)\1\1")
_DISGUISED = re.compile(rf"[^\W\d_]*(?:[{_SIGNS}]+[^\W\d_]*)+")
_CODES = np.zeros(256, dtype=np.int64)
_CODES[ord("a"):ord("z") + 1] = np.arange(1, 27)
_CODES[ord("A"):ord("Z") + 1] = np.arange(1, 27)
_CODES[0x80:] = 27  # letters beyond a-z are one class
_N = 28


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def character_counts(docs: DataFrame) -> np.ndarray:
    """Counts of character trigrams over all texts (a fixed number of classes)."""

    def count(batches):
        for batch in batches:
            total = np.zeros(_N ** 3, dtype=np.int64)
            for _, buf, offsets in R.chunks(batch.column(0)):
                codes = np.zeros(len(buf) + 2 * len(offsets), dtype=np.int64)
                doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
                codes[np.arange(len(buf)) + 2 * doc + 2] = _CODES[buf]
                total += np.bincount(codes[:-2] * _N * _N + codes[1:-1] * _N + codes[2:], minlength=_N ** 3)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["k", "c"])

    rows = docs.select("text").mapInArrow(count, "k bigint, c bigint").groupBy("k").agg(F.sum("c").alias("c")).collect()
    out = np.zeros(_N ** 3)
    for r in rows:
        out[r.k] = r.c
    return out.reshape(_N, _N, _N)


class Decoder:
    """Viterbi decoding of disguised words under the trigram model."""

    def __init__(self, counts: np.ndarray):
        one = counts.sum(axis=(0, 1)) + 1.0
        two = counts.sum(axis=0)
        p1 = one / one.sum()
        p2 = (two + 50 * p1) / (two.sum(axis=1, keepdims=True) + 50)
        p3 = (counts + 20 * p2[None]) / (counts.sum(axis=2, keepdims=True) + 20)
        self.log = np.log(p3).tolist()
        self.known: dict[str, str] = {}

    @staticmethod
    def _code(letter: str) -> int:
        return ord(letter) - 96 if "a" <= letter <= "z" else 27

    def decode(self, word: str) -> list[str]:
        """The likeliest plain words, one for each ending of two letters; gaps may become blanks."""
        if len(word) > REMEMBERED:
            return self._viterbi(word)
        got = self.known.get(word)
        if got is None:
            if len(self.known) > 200_000:
                self.known.clear()
            got = self.known[word] = self._viterbi(word)
        return got

    def _viterbi(self, word: str) -> list[str]:
        # per state the score and the letters so far, linked from the last one back
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        run = [n for _, same in groupby(word) for n in [len(list(same))] for _ in range(n)]
        for i, sign in enumerate(word):
            stands = LOOKALIKES.get(sign)
            if sign in _GAPS:
                options = [(" ", _GAPS[sign][0]), ("", _GAPS[sign][1])]
            elif stands is None:
                options = [(sign, 0.0)] if sign.isalpha() else []
                if i and word[i - 1] == sign and run[i] > 2:
                    options.append(("", -1.0))
            else:
                # leaving a letter out saves its cost under the model, so it must cost more than one does
                options = [(x, -0.7 - math.log(len(stands))) for x in stands]
                options.append(("", -0.1 if not stands else -1.0 if i and word[i - 1] == sign else -14.0))
            reached: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, letters) in best.items():
                for letter, cost in options or [("", 0.0)]:
                    if letter:
                        c = 0 if letter == " " else self._code(letter)
                        state, value = (b, c), score + cost + self.log[a][b][c]
                    else:
                        state, value = (a, b), score + cost
                    if state not in reached or value > reached[state][0]:
                        reached[state] = value, (letters, letter) if letter else letters
            best = reached
        ends = []
        for (a, b), (score, letters) in best.items():
            text = []
            while letters:
                letters, letter = letters
                text.append(letter)
            ends.append((score + self.log[a][b][0], "".join(reversed(text))))
        return [text for _, text in sorted(ends, reverse=True)[:READINGS] if text]

    def words(self, text: str) -> set[str]:
        """Distinct restored words of a text."""
        text = text.lower()
        found = set(text.split())
        out = set()
        for raw in found:
            word = raw.strip(_EDGES)
            if word.isalpha():
                self._plain(word, out)
            elif word:
                out.add(word)
                if _DISGUISED.fullmatch(word):
                    out.update(self.decode(word))
                    if len(parts := _JOINED.split(word)) > 1:  # a chain of words
                        for part in parts:
                            if part.isalpha():
                                self._plain(part, out)
                            elif part:
                                out.update(self.decode(part))
                if _DISGUISED.fullmatch(raw):  # signs at the edges may be letters too
                    out.update(self.decode(raw))
        for spelled in _SPELLED.findall(text):
            out.update(self.decode(spelled.replace(" ", "")))
            for reading in self.decode(_with_gaps(spelled)):
                out.update(reading.split())
        return out

    def _plain(self, word: str, out: set[str]) -> None:
        out.add(word)
        if _THRICE.search(word):
            out.update(self.decode(word))


def _with_gaps(spelled: str) -> str:
    """A spelled run with each gap as one sign: wide when longer, or blank, where others are not."""
    gaps = set(_GAP.findall(spelled))
    narrow = min(map(len, gaps))
    dense = any(len(g) == narrow and not g.isspace() for g in gaps)
    return _GAP.sub(lambda g: WIDE if len(g[0]) > narrow or dense and g[0].isspace() else NARROW, spelled)


def features(word: str) -> list[str]:
    """The word, and what it begins and ends with."""
    n = len(word)
    return ["=" + word, *("<" + word[:k] for k in (4, 5, 6) if n > k), *(">" + word[-k:] for k in (4, 5, 6) if n > k)]


def _all_features(words: set[str]) -> set[str]:
    return {f for w in words for f in features(w)}


def _texts(batches):
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
            yield row


def choose_indicators(sample: DataFrame, decoder) -> list[str]:
    """Features that mark toxic documents of the sample, greedily."""

    def holders(batches):
        """Toxic and clean holders of every feature, handed on when many are held."""
        counts: dict[str, list[int]] = {}

        def counted():
            n = list(zip(*counts.values())) or [(), ()]
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(n[1], pa.int64()),
                                               pa.array(n[0], pa.int64())], names=["f", "t", "c"])

        for toxic, text in _texts(batches):
            for f in _all_features(decoder.value.words(text or "")) if toxic in (0, 1) else ():
                counts.setdefault(f, [0, 0])[toxic] += 1
            if len(counts) > HELD:
                yield counted()
                counts.clear()
        yield counted()

    rows = sample.select("toxic", "text").mapInArrow(holders, "f string, t bigint, c bigint")
    good = (rows.groupBy("f").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
            .where((F.col("t") >= MIN_DOCS) & (F.col("t") / (F.col("t") + F.col("c")) >= MIN_PRECISION)).collect())
    names, clean = [r.f for r in good], [r.c for r in good]
    wanted = sample.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(names)})

    def held(batches):
        number = wanted.value
        for _, text in _texts(batches):
            words = decoder.value.words(text or "")
            here = [number[f] for f in _all_features(words) if f in number]
            kin = min((zlib.crc32(w.encode()) for w in words), default=0)
            yield pa.RecordBatch.from_arrays([pa.array([kin], pa.int64()), pa.array([here], pa.list_(pa.int32()))],
                                             names=["kin", "fs"])

    # the toxic ones of at most SAMPLE rows, with the features that passed
    rows = sample.where("toxic = 1").select("toxic", "text").mapInArrow(held, "kin bigint, fs array<int>")
    marked, kin = [], []
    for r in rows.collect():
        marked.append(r.fs)
        kin.append(r.kin)
    by_feature: dict[int, set[int]] = defaultdict(set)
    for d, fs in enumerate(marked):
        for f in fs:
            by_feature[f].add(d)
    families = {f: len({kin[d] for d in ds}) for f, ds in by_feature.items()}
    known = sorted((f for f, n in families.items() if n >= FAMILIES), key=lambda f: (-families[f], names[f]))
    chosen = [names[f] for f in known]
    for f in known:
        for d in by_feature.pop(f):
            for other in marked[d]:
                if other in by_feature:
                    by_feature[other].discard(d)
    # counts only fall, so an entry that still holds its count is the best one
    queue = [(-len(ds), clean[f], names[f], f) for f, ds in by_feature.items() if len(ds) >= MIN_DOCS]
    heapify(queue)
    while queue:
        n, _, name, f = queue[0]
        left = by_feature[f]
        if len(left) < MIN_DOCS:
            heappop(queue)
        elif len(left) < -n:
            heapreplace(queue, (-len(left), clean[f], name, f))
        else:
            heappop(queue)
            chosen.append(name)
            for d in list(left):
                for other in marked[d]:
                    if other in by_feature:
                        by_feature[other].discard(d)
    return chosen


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> np.ndarray:
    """Newton steps for a ridge-regularised logistic model; the first column is the intercept."""
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) - penalty * beta
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(penalty + 1e-9), gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _count(docs: DataFrame, decoder, indicators: list[str], columns: list[str], sql: str) -> DataFrame:
    """``columns`` of every row and the number of its distinct words that carry an indicator."""
    known = docs.sparkSession.sparkContext.broadcast(frozenset(indicators))

    def score(batches):
        marks, seen = known.value, {}
        for batch in batches:
            hits = []
            for text in batch.column("text").to_pylist():
                n = 0
                for word in decoder.value.words(text or "") if marks else ():
                    hit = seen.get(word)
                    if hit is None:
                        if len(seen) > 300_000:
                            seen.clear()
                        hit = seen[word] = any(f in marks for f in features(word))
                    n += hit
                hits.append(n)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(hits, pa.int64())],
                                             names=[*columns, "hits"])

    return docs.select(*columns, "text").mapInArrow(score, sql + ", hits bigint")


def inputs(hits) -> np.ndarray:
    hits = np.asarray(hits, dtype=float)
    return np.stack([np.ones(len(hits)), hits > 0, np.log1p(hits)], axis=1)


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted, hits per row of ``docs``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    decoder = spark.sparkContext.broadcast(Decoder(character_counts(docs)))
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")))
    # at most sample_rows ids
    few = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = docs.join(F.broadcast(few), "doc_id").select("toxic", "text").persist()
    indicators = choose_indicators(sample, decoder)
    learned = _count(sample, decoder, indicators, ["toxic"], "toxic int").groupBy("toxic", "hits").count().collect()
    sample.unpersist()
    weights = np.array([r["count"] for r in learned], dtype=np.int64)
    y = np.repeat(np.array([r.toxic for r in learned], dtype=float), weights)
    if not 0 < y.sum() < len(y):
        beta = [-40.0, 0.0, 0.0]
    else:
        beta = fit_logistic(np.repeat(inputs([r.hits for r in learned]), weights, axis=0), y).tolist()
    counted = _count(docs, decoder, indicators, ["doc_id"], "doc_id bigint")
    logit = beta[0] + beta[1] * (F.col("hits") > 0).cast("double") + beta[2] * F.log1p("hits")
    score = 1 / (1 + F.exp(-logit))
    return counted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"),
                          (score >= 0.5).cast("int").alias("predicted"), "hits")
