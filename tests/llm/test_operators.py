"""Every operator against its plain version on a small table with all edge cases."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lograft.llm import (decontaminate, jaccard_join, line_dedup, packing, quality_rules, sharding, substring_dedup,
                         suffix_dedup, toxicity, url_filter)
from lograft.llm.suffix_dedup import suffix_order

from . import plain


def got(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80), (1, 50)])
def test_jaccard_join(docs, rows, words, percent):
    found = got(jaccard_join.jaccard_join(docs, words, percent), "doc_id", "n_shingles", "component_id")
    assert found == Counter(plain.components(rows, words, percent))


def test_keep_one_leaves_one_row_per_component(docs, rows):
    left = jaccard_join.keep_one(docs, 5, 80)
    assert left.columns == docs.columns
    parts = plain.components(rows, 5, 80)
    single = {c for _, n, c in parts if n}
    assert left.where(F.size(F.split(F.trim(F.coalesce("text", F.lit(""))), r"\s+")) >= 1).count() == \
        len(single - {None}) + sum(1 for i, n, c in parts if n and c is None) + sum(1 for _, n, _ in parts if not n)


def test_prefix_tree_agrees_with_sets():
    pick = np.random.default_rng(5)
    base = np.unique(pick.integers(0, 4000, 300)).astype(np.uint64)
    sets = [np.unique(np.concatenate((base[pick.random(len(base)) > drop], pick.integers(0, 9000, 12).astype(np.uint64))))
            for drop in pick.random(40) * 0.3] + [base, base, base[:50]]
    tree = jaccard_join.PrefixTree(sets)
    for s in sets:
        shared = [len(np.intersect1d(s, x)) for x in sets]
        want = [i for i, n in enumerate(shared) if 100 * n >= 85 * (len(s) + len(sets[i]) - n)]
        assert list(tree.probe(s, range(len(sets)), 85)) == want


@pytest.mark.parametrize("busy_from", [4096, 1])
def test_substring_dedup(docs, rows, busy_from):
    spec = substring_dedup.Spec("word", 50, gram=16, busy_from=busy_from)
    found = got(substring_dedup.dedup_substrings(docs, spec), "doc_id", "n_units", "n_removed", "kept_sha256")
    assert found == Counter(plain.repeats(rows, "word"))


@pytest.mark.parametrize("busy_from", [4096, 1])
def test_suffix_dedup(docs, rows, busy_from):
    spec = suffix_dedup.Spec("byte", 50, gram=24, busy_from=busy_from)
    found = got(suffix_dedup.dedup_bytes(docs, spec), "doc_id", "n_units", "n_removed", "kept_sha256")
    assert found == Counter(plain.repeats(rows, "byte"))


def test_suffix_order_sorts_suffixes():
    pick = np.random.default_rng(2)
    for n in range(60):
        for letters in (1, 2, 4):
            s = pick.integers(0, letters, n).tolist()
            assert suffix_order(s) == sorted(range(n), key=lambda i: s[i:])


def test_line_dedup(docs, rows):
    assert got(line_dedup.digest(docs), "doc_id", "n_lines", "n_dropped", "kept_sha256") == Counter(plain.line_dedup(rows))


def test_keep_runs_restore_the_kept_lines(docs, rows):
    r = line_dedup.kept(line_dedup.dedup_lines(docs)).where("n_dropped > 0").first()
    lines = r.row.text.split("\n")
    assert "\n".join(x for a, n in r.keep_runs for x in lines[a:a + n]) == r.kept_text
    assert sum(n for _, n in r.keep_runs) == r.n_lines - r.n_dropped


def test_quality_counts(docs, rows):
    found = got(quality_rules.base_counts(docs).withColumn("b", quality_rules.base_failed()), "doc_id", "n_words", "word_chars",
                "n_symbols", "n_dup_lines", "n_repeat_words", "b")
    want = Counter()
    for i, t in rows:
        c = plain.counts(t)
        want[(i, *c, c[0] < 50 or 100 * c[4] > 50 * c[0])] += 1
    assert found == want


def test_quality_rules_learn_and_keep_clean_rows(spark):
    words = [f"w{i}" for i in range(400)]
    text = lambda i, mark: " ".join(w + mark * (k % 2) for k, w in enumerate(words[i % 200:i % 200 + 80]))
    rows = [(i, text(i, "%%" if i % 4 == 0 else "")) for i in range(400)]
    docs = spark.createDataFrame([*rows, (1000, None), (None, text(1, ""))], "doc_id long, text string")
    labels = spark.createDataFrame([*[(i, 0 if i % 4 == 0 else 1) for i, _ in rows if i % 5], (None, 0), (3, None)],
                                   "doc_id long, quality int")
    judged, rules = quality_rules.judge(docs, labels)
    assert rules
    kept = {r.doc_id: r.kept for r in judged.collect()}
    assert all(kept[i] == (i % 4 != 0) for i in range(400)) and kept[1000] is False and kept[None] is True
    _, none = quality_rules.judge(docs, labels.limit(0))
    assert none == []


def test_decontamination(spark, docs, rows):
    taken = [(i, t) for i, t in rows if t and len(t.split()) > 60]
    items = [(1, " ".join(taken[0][1].split()[20:45])), (2, taken[1][1].upper()[:200]), (2, taken[1][1].upper()[:200]),
             (10, "a b c"), (3, None), (4, ""), (None, " ".join(taken[2][1].split()[3:14])), (5, "never seen words at all")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = Counter(plain.decontaminate(rows, items))
    assert got(decontaminate.decontaminate(docs, bench), *columns) == want
    sliced = decontaminate.decontaminate(docs, bench, slice_bytes=150)
    assert got(sliced, *columns) == want
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == docs.columns
    assert clean.count() == sum(n for k, n in want.items() if not k[-1])


def test_decontamination_with_shared_and_repeated_windows(spark, monkeypatch):
    """Few different words: windows repeat within items, between items and within documents."""
    monkeypatch.setattr(decontaminate, "_STEP", 3)  # long items leave their task in many parts
    dice = np.random.default_rng(5)
    text = lambda n: " ".join(dice.choice(["a", "b", "c"], n))
    rows = [(int(i) if i % 7 else None, text(int(dice.integers(0, 60)))) for i in range(60)]
    items = [(i % 25, text(int(dice.integers(0, 14)))) for i in range(40)] + [(99, text(200))]
    items += [(100 + i, items[-1][1]) for i in range(30)]
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = Counter(plain.decontaminate(rows * 2, items, n=6))
    assert got(decontaminate.decontaminate(docs, bench, window=6), *columns) == want
    assert got(decontaminate.decontaminate(docs, bench, window=6, slice_bytes=4000), *columns) == want


def test_proximity_search(spark):
    docs = spark.createDataFrame([(1, "one two three four"), (2, "one x two three four"), (3, "four three two one")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(7, "one two three four")], "item_id long, text string")
    near = {r.doc_id: r.contaminated for r in decontaminate.decontaminate(docs, bench, slop=1).collect()}
    assert near[1] and not near[3]
    assert {r.doc_id for r in decontaminate.decontaminate(docs, bench).where("contaminated").collect()} == {1}


def test_packing_places_every_token_once(docs, rows):
    pieces = packing.pack_documents(docs, group_tokens=20000).collect()
    per_row, bins = defaultdict(list), defaultdict(list)
    for p in pieces:
        per_row[p.row_no].append(p)
        if p.bin is not None:
            bins[p.bin].append(p)
    assert len(per_row) == len(rows)
    assert Counter((v[0].doc_id, sum(p.n_tokens for p in v)) for v in per_row.values()) == \
        Counter((i, len(plain.words(t))) for i, t in rows)
    for v in per_row.values():
        at = 0
        for p in sorted(v, key=lambda p: p.piece):
            assert p.first_token == at
            at += p.n_tokens
    for v in bins.values():
        at = 0
        for p in sorted(v, key=lambda p: p.bin_offset):
            assert p.bin_offset == at
            at += p.n_tokens
        assert v[0].bin_length == min(c for c in packing.LENGTHS if c >= at)


def test_best_fit_takes_the_tightest_bin():
    pick = np.random.default_rng(1)
    sizes = sorted(pick.integers(1, 4097, 400).tolist(), reverse=True)
    where, offset, final, opened = packing.best_fit(sizes)
    free: dict[int, int] = {}
    for n, b in zip(sizes, where):
        fitting = {k: v for k, v in free.items() if v >= n}
        if b in free:
            assert free[b] == min(fitting.values())
        else:
            assert not fitting
            free[b] = opened[b]
        free[b] -= n
    assert sum(sizes) / sum(final) > 0.9


def test_url_filter(spark):
    urls = ["http://A.example.org/es/1", "https://example.org/en/12?x", "http://x.org", "http://b.com/fr/2#t", "http://b.com/de/",
            "http://free-bets.b.com/en/", "http://free-bets.b.org/en/", "http://b.net/", "no scheme", None, "", "http://",
            "http://freebets.net/a", "ftp://casino-win.net", "http://b.com?x=/de/", "http://notexample.org/es/1"]
    pages = spark.createDataFrame([(i, u, None, "x") for i, u in enumerate(urls)] + [(0, urls[0], None, "x"), (None, None, None, None)],
                                  "page_id long, url string, html string, shard string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages).collect()}
    assert found[0] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert found[1] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert found[2] == ("x.org", "", None, "allow")
    assert found[3] == ("b.com", "/fr/2", "com/fr/", "allow") and found[4][2:] == ("com/de/", "block")
    assert found[5][2:] == (None, "block") and found[6][2:] == ("org/", "allow") and found[7][2:] == (None, "allow")
    assert found[8] == found[9] == found[10] == found[None] == ("", "", None, "allow")
    assert found[12][3] == "allow" and found[13][3] == "block" and found[15][2:] == ("org/", "allow")
    spread = url_filter.filter_urls(pages, shard_keys=3, broadcast_bytes=0, salts=2)
    assert got(spread, "page_id", "host", "path", "rule", "verdict") == \
        got(url_filter.filter_urls(pages), "page_id", "host", "path", "rule", "verdict")


def test_cascade_is_exact_for_its_universe():
    pick = np.random.default_rng(4)
    a, b = (pick.integers(0, 1 << 63, 50000).astype(np.uint64) for _ in range(2))
    for share in (0, 0.001, 0.3, 1):
        listed = pick.random(50000) < share
        assert (url_filter.Cascade.build(a, b, listed).holds(a, b) == listed).all()


def test_sharding(docs, rows):
    found = sharding.shard_rows(docs).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == want
    for s in range(sharding.SHARDS):
        slots = sorted(r.slot for r in found if r.shard == s)
        assert slots == list(range(len(slots)))
    assert {r.law for r in found} == {"bytes"} and {r.grown_shard for r in found} == {None}


def test_sharding_splits_a_hot_group_and_balances_bytes(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text " * 20)
                                    .otherwise(F.repeat(F.col("id").cast("string"), 40)).alias("text"))
    without_id = docs.withColumn("doc_id", F.when(F.length("text") != 200, F.col("doc_id")))  # the hot group has no ids
    for rows in (docs, without_id):
        found = sharding.shard_rows(rows).persist()
        size = found.groupBy("shard").agg(F.sum("size").alias("s"), F.count("*").alias("n"), F.min("slot").alias("low"),
                                          F.max("slot").alias("high"), F.countDistinct("slot").alias("slots")).collect()
        mean = sum(r.s for r in size) / 16
        assert len(size) == 16 and max(abs(r.s - mean) for r in size) < 0.02 * mean
        assert all((r.low, r.high, r.slots) == (0, r.n - 1, r.n) for r in size)
        assert dict(found.dtypes)["slot"] == "bigint"


def test_toxicity_learns_restores_and_scores(spark):
    pick = np.random.default_rng(8)
    syllables = ["re", "on", "ti", "ba", "ler", "min", "the", "ou", "ast", "en"]
    plain_words = ["".join(pick.choice(syllables, pick.integers(1, 5))) for _ in range(300)]
    bad = ["idiot", "moron", "pathetic"]
    rows, labels = [], []
    for i in range(900):
        w = pick.choice(plain_words, 60).tolist()
        toxic = i % 9 == 0
        if toxic:
            for _ in range(3):
                w[pick.integers(60)] = bad[int(pick.integers(3))]
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    disguised = ["an 1d10t here", "such a p4th3t1c one", "you m o r o n there", "iiidiooot says so", "M0r0n!"]
    rows += [(5000 + i, t + " " + " ".join(plain_words[:20])) for i, t in enumerate(disguised)]
    rows += [(6000, None), (6001, ""), (None, "idiot moron")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    right = [found[i].predicted == t for i, t in labels if found[i].held_out]
    assert sum(right) / len(right) > 0.97
    assert [found[5000 + i].predicted for i in range(len(disguised))] == [1] * len(disguised), [found[5000 + i] for i in range(len(disguised))]
    assert found[6000].predicted == 0 and found[6001].predicted == 0 and found[None].predicted == 1
    assert all(0 <= r.score <= 1 for r in found.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items() if i is not None)
    unlabelled = toxicity.toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int")).agg(F.max("score")).first()[0]
    assert unlabelled < 0.5


def made_up(n, seed, length=9):
    letters = np.random.default_rng(seed).integers(97, 123, (n, length)).astype(np.uint8)
    return [bytes(w).decode() for w in letters]


def chosen_indicators(spark, rows):
    decoder = spark.sparkContext.broadcast(toxicity.Decoder(np.ones((28, 28, 28))))
    return toxicity.choose_indicators(spark.createDataFrame(rows, "toxic int, text string"), decoder)


def test_toxicity_examines_rare_features_behind_many_common_ones(spark):
    common = " ".join(made_up(4000, 1))  # some 28,000 features, each in more toxic rows than the rare word
    rows = [(1, common + (" qxzvkwjq" if i < 3 else "")) for i in range(8)] + [(0, common)] * 8
    assert {f[1:] for f in chosen_indicators(spark, rows)} <= {"qxzvkwjq"[:k] for k in (4, 5, 6, 8)} | \
        {"qxzvkwjq"[-k:] for k in (4, 5, 6)}
    assert chosen_indicators(spark, rows)


def test_toxicity_keeps_every_known_feature_and_ends_on_min_docs_alone(spark):
    filler = iter(made_up(8000, 2, 12))
    text = lambda word: " ".join([word, *(next(filler) for _ in range(12))])
    # words of 7 features each; none has the smallest hash of its document
    words = [w for w in made_up(500, 3) if zlib.crc32(w.encode()) > 3 << 30]
    known, rare = words[:60], words[60:70]
    rows = [(1, text(w)) for w in known for _ in range(toxicity.FAMILIES)]
    rows += [(1, text(w)) for w in rare for _ in range(toxicity.MIN_DOCS)] + [(0, text("plain")) for _ in range(9)]
    chosen = chosen_indicators(spark, rows)
    assert {"=" + w for w in known} <= set(chosen)
    assert all(any(f in chosen for f in toxicity.features(w)) for w in rare)


def test_toxicity_decodes_runs_of_any_length():
    said = "you are such an idiot and we all know that you never do anything right at all my friend"
    counts = np.zeros((28, 28, 28))
    codes = [0, 0, *(0 if c == " " else ord(c) - 96 for c in (said + " ") * 40)]
    np.add.at(counts, (codes[:-2], codes[1:-1], codes[2:]), 1)
    decoder = toxicity.Decoder(counts)
    want = set(said.split())
    assert want <= decoder.words("  ".join(" ".join(w) for w in said.split()))  # wide gaps between words
    assert want <= decoder.words(" ".join(".".join(w) for w in said.split()))
    assert "idiot" in decoder.words(" ".join(said.replace(" ", "")))  # the same gap everywhere
    assert "idiot" in decoder.words("-".join("such an idiot".replace(" ", "")))
    assert "idiot" in decoder.words("idi" + "o" * 300 + "t")
    for joint in "_-.":
        assert want <= decoder.words(said.replace(" ", joint))
        assert "idiot" in decoder.words(said.replace("idiot", "1d10t").replace(" ", joint))
    decoder.words(" ".join("a" * 5000))  # a long run costs time in proportion to its length


def test_empty_tables(spark, nothing):
    empty = lambda sql: spark.createDataFrame([], sql)
    bench, labels = empty("item_id long, text string"), empty("doc_id long, quality int, toxic int")
    results = [jaccard_join.jaccard_join(nothing), jaccard_join.keep_one(nothing, 5, 80),
               substring_dedup.dedup_substrings(nothing), suffix_dedup.dedup_bytes(nothing), line_dedup.digest(nothing),
               quality_rules.judge(nothing, labels)[0], packing.pack_documents(nothing), sharding.shard_rows(nothing),
               decontaminate.decontaminate(nothing, bench), toxicity.toxicity(nothing, labels),
               url_filter.filter_urls(empty("page_id long, url string"))]
    assert [df.count() for df in results] == [0] * len(results)


def test_empty_benchmark_hits_nothing(spark, docs, rows):
    got_ = decontaminate.decontaminate(docs, spark.createDataFrame([], "item_id long, text string"))
    assert got_.where("contaminated").count() == 0 and got_.count() == len(rows)
