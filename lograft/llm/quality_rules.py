r"""Quality rules: a learned decision list, with DataFrame functions only.

Every text is turned into a few counts and ratios.  The list is learned from
labelled rows by sequential covering: a rule grows threshold by threshold
towards the rows to reject (information gain on two thirds of the labelled
rows), is pruned from its end on the other third, and enters the list if it is
precise enough there; the rows it covers leave and the next rule is grown.  Each
step asks Spark for one table of counts per feature and threshold, which is as
small for any corpus.  The result is an ordered conditional expression: the
first rule that fits rejects, a row that none fits is kept.

Defined results: a null text has no words and fails the base rule; without
labelled rows of both kinds the list is empty and every row that passes the base
rule is kept; label rows with nulls are not used; of several labels of a doc_id
each counts; rows that share a doc_id are judged each on its own text; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.frames import with_computed
from ..session import scratch_path
from .native import spaced, word_array

MIN_WORDS = 50
FEATURES = ("word_length", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "distinct_ratio", "upper_ratio",
            "mark_ratio", "bar_ratio")
CUTS = 32  # thresholds a feature
MAX_RULES, MAX_TERMS = 12, 3
MIN_PRECISION, MIN_COVER = 0.95, 5


def repeated_window_words(words: Column, hashes: Column) -> Column:
    """Words in 3-word windows that occur twice or more; ``hashes`` are those of the windows."""
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    neighbours = F.zip_with(pairs, F.slice(pairs, 2, F.greatest(F.size(pairs) - 1, F.lit(0))),
                            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    starts = F.array_sort(F.array_distinct(F.flatten(F.filter(neighbours, lambda p: p.isNotNull()))))
    seen = F.aggregate(starts, F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
                       lambda s, x: F.struct((x + 3).alias("end"), (s["n"] + x + 3 - F.greatest(s["end"], x)).alias("n")),
                       lambda s: s["n"])
    # most texts repeat no window, which a hash set shows without sorting
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), seen).otherwise(F.lit(0).cast("long"))


def text_mark(text: Column) -> Column:
    """With doc_id, what a row is known by."""
    return F.xxhash64(text)


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, mark (``text_mark``), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the learner's features."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = with_computed(docs.select("doc_id", "text", text_mark(F.col("text")).alias("mark")), {
        "spaced": spaced(F.col("text")), "lines": lines,
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_upper": F.regexp_count(text, F.lit("[A-Z]")).cast("long"),
        "n_marks": F.regexp_count(text, F.lit("[!?]")).cast("long"),
        "n_bars": F.regexp_count(text, F.lit(r"[\x20\x09-\x0D][^\p{L}\p{N}\x20\x09-\x0D]+[\x20\x09-\x0D]")).cast("long"),
    }, drop=["text"])
    step = with_computed(step, {
        "words": word_array(F.col("spaced")), "n_chars": F.length("spaced"), "n_lines": F.size("lines"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")}, drop=["spaced", "lines"])
    n = F.size("words")
    window = lambda i: F.xxhash64(*(F.get("words", i + k) for k in range(3)))
    hashes = F.when(n > 2, F.transform(F.sequence(F.lit(0), n - 3), window)).otherwise(F.array().cast("array<bigint>"))
    step = with_computed(step, {"hashes": hashes, "n_words": n.cast("long"),
                                "n_distinct": F.size(F.array_distinct("words"))}, drop=[])
    step = with_computed(step, {"n_repeat_words": repeated_window_words(F.col("words"), F.col("hashes"))},
                         drop=["words", "hashes"])
    words, chars = F.col("n_words"), (F.col("n_chars") - F.greatest(F.col("n_words") - 1, F.lit(0))).cast("long")
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    return step.select(
        "doc_id", "mark", "n_words", chars.alias("word_chars"), "n_symbols", "n_dup_lines", "n_repeat_words",
        ratio(chars, words).alias("word_length"), ratio(F.col("n_symbols"), words).alias("symbol_ratio"),
        ratio(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_ratio"),
        ratio(F.col("n_repeat_words"), words).alias("repeat_ratio"),
        ratio(F.col("n_distinct"), words).alias("distinct_ratio"), ratio(F.col("n_upper"), chars).alias("upper_ratio"),
        ratio(F.col("n_marks"), words).alias("mark_ratio"), ratio(F.col("n_bars"), words).alias("bar_ratio"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Term:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        return F.col(self.feature) > self.cut if self.above else F.col(self.feature) <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


def fits(terms: list[Term]) -> Column:
    out = F.lit(True)
    for t in terms:
        out = out & t.column()
    return out


def _counts(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[Term, tuple[int, int]]:
    """(to reject, to keep) among the rows that each candidate threshold fits."""
    rank = [F.struct(F.lit(f).alias("f"), sum((F.when(F.col(f) > c, 1).otherwise(0) for c in cuts[f]), F.lit(0)).alias("bin"))
            for f in cuts]
    table = (rows.select("bad", F.explode(F.array(*rank)).alias("x")).groupBy("x.f", "x.bin")
             .agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect())
    out: dict[Term, tuple[int, int]] = {}
    for f, cut in cuts.items():
        bins = {r.bin: (r.p, r.n) for r in table if r.f == f}
        total = [sum(v[i] for v in bins.values()) for i in (0, 1)]
        p = n = 0
        for i, c in enumerate(cut):  # bin i holds the values above exactly i cuts
            p, n = p + bins.get(i, (0, 0))[0], n + bins.get(i, (0, 0))[1]
            out[Term(f, False, c)] = (p, n)
            out[Term(f, True, c)] = (total[0] - p, total[1] - n)
    return out


def _weigh(rows: DataFrame, prefixes: list[list[Term]]) -> list[tuple[int, int]]:
    """(to reject, to keep) that each conjunction fits, in one aggregation."""
    sums = []
    for i, terms in enumerate(prefixes):
        fit = fits(terms).cast("int")
        sums += [F.sum(fit * F.col("bad")).alias(f"p{i}"), F.sum(fit * (1 - F.col("bad"))).alias(f"n{i}")]
    row = rows.agg(*sums).first()
    return [(row[f"p{i}"] or 0, row[f"n{i}"] or 0) for i in range(len(prefixes))]


def _centred(bad: DataFrame, terms: list[Term]) -> list[Term]:
    """Thresholds moved half-way to the nearest covered row to reject, so that rows just beyond those seen are kept."""
    ends = bad.where(fits(terms)).agg(*[(F.min if t.above else F.max)(t.feature).alias(f"e{i}")
                                        for i, t in enumerate(terms)]).first()
    return [Term(t.feature, t.above, t.cut if ends[i] is None else (t.cut + ends[i]) / 2) for i, t in enumerate(terms)]


def learn(labelled: DataFrame) -> list[list[Term]]:
    """The decision list: conjunctions that reject, in order.

    ``labelled`` has the features, ``bad`` (1: to reject) and ``prune`` (held for pruning).
    """
    names = list(FEATURES)
    quantiles = [i / (CUTS + 1) for i in range(1, CUTS + 1)]
    # thresholds from the rows to reject too: they may be too few to show in the others' quantiles
    found = labelled.agg(*[F.percentile_approx(f, quantiles, 10000).alias(f) for f in names],
                         *[F.percentile_approx(F.when(F.col("bad") == 1, F.col(f)), quantiles, 10000).alias("b_" + f)
                           for f in names]).first()
    cuts = {f: sorted({*(found[f] or ()), *(found["b_" + f] or ())}) for f in names}
    rules: list[list[Term]] = []
    left = labelled
    for _ in range(MAX_RULES):
        grow, prune = left.where(~F.col("prune")), left.where("prune")
        terms: list[Term] = []
        have: tuple[int, int] | None = None
        while len(terms) < MAX_TERMS:
            counts = _counts(grow.where(fits(terms)), cuts)
            if have is None:
                have = next((tuple(map(sum, zip(counts[Term(f, False, c)], counts[Term(f, True, c)])))
                             for f in names for c in cuts[f]), (0, 0))
            if not have[0] or not have[1]:
                break
            now = math.log2(have[0] / sum(have))
            best = max(counts, key=lambda t: counts[t][0] * (math.log2(counts[t][0] / sum(counts[t])) - now)
                       if counts[t][0] else -math.inf)
            p, n = counts[best]
            if p < MIN_COVER or p * (math.log2(p / (p + n)) - now) <= 0:
                break
            terms.append(best)
            have = (p, n)
        if not terms:
            break
        prefixes = [terms[:i] for i in range(1, len(terms) + 1)]
        weight = _weigh(prune, prefixes)
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in weight]
        at = max(range(len(prefixes)), key=lambda i: (worth[i], -i))
        p, n = weight[at]
        if p + n == 0 or p / (p + n) < MIN_PRECISION:
            break
        rules.append(_centred(left.where(F.col("bad") == 1), prefixes[at]))
        left = left.where(~fits(prefixes[at]))
    return rules


def verdict(rules: list[list[Term]]) -> Column:
    """The list as one ordered conditional expression: true keeps."""
    out = None
    for terms in rules:
        out = F.when(fits(terms), False) if out is None else out.when(fits(terms), False)
    return F.lit(True) if out is None else out.otherwise(True)


def judge(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[list[Term]]]:
    """Counts, features, base_failed and kept of every document, and the list learned."""
    spark = docs.sparkSession
    path = scratch_path(spark, "quality-features")
    # the only pass over the texts
    base_counts(docs).withColumn("base_failed", base_failed()).write.parquet(path)
    rows = spark.read.parquet(path)
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).select(
        "doc_id", (1 - F.col("quality").cast("int")).alias("bad"))
    trained = scratch_path(spark, "quality-labelled")
    (rows.where(~F.col("base_failed")).join(marks, "doc_id")
     .select("bad", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prune"), *FEATURES).write.parquet(trained))
    rules = learn(spark.read.parquet(trained))
    return rows.withColumn("kept", ~F.col("base_failed") & verdict(rules)), rules


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept; rows are known by doc_id and text, and only the keys of the rejected move."""
    judged, _ = judge(docs, labels)
    bad = judged.where(~F.col("kept")).select(F.col("doc_id").alias("bad_id"), "mark").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), text_mark(F.col("text")).alias("m"))
    same = F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("m") == F.col("mark"))
    return rows.join(bad, same, "left_anti").select("row.*")
