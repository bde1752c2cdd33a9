"""The pipeline's stages against plain versions, each on its own input."""

from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from . import plain

SF = "/root/testdata/sf0.001"


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    given = []
    for name, stage in corpus_pipeline.STAGES:
        given.append(docs)
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "best_fit_packing":
            assert docs.columns == columns
    judged, lined, single, clean = (texts(d) for d in given[1:])
    before = texts(given[0])
    failing = {i for i, t in before for c in [plain.counts(t)] if c[0] < 50 or 100 * c[4] > 50 * c[0]}
    assert not failing & {i for i, _ in judged} and len(judged) > 0.8 * (len(before) - len(failing))
    want = Counter((i, s) for i, _, _, s in plain.line_dedup(judged))
    assert Counter((i, plain.sha(t.encode())) for i, t in lined) == want
    smallest = {c for _, n, c in plain.components(lined, 5, 80) if n}
    assert {i for i, t in single if plain.words(t)} == smallest
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {i for i, _ in clean} == {r[0] for r in plain.decontaminate(single, bench) if not r[-1]}
    packed = docs.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()
    assert {r.doc_id: r.n for r in packed} == {i: len(plain.words(t)) for i, t in clean}
    assert docs.groupBy("bin").agg(F.sum("n_tokens").alias("n"), F.max("bin_length").alias("l")).where("n > l").count() == 0


def _tables(spark, folder, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_pipeline_on_nulls_repeats_and_nothing(spark, tmp_path):
    """Rows without words fail the base rule; equal texts leave one document, that of the smallest doc_id."""
    good = " ".join(f"word{i}x{i % 7}" for i in range(90))
    rows = [(1, good, "en", "a", len(good)), (2, good, None, None, None), (1, good, "en", "a", len(good)), (None, good, "en", "a", 5),
            (3, None, "en", "a", None), (4, "", "en", "a", 0), (None, None, None, None, None), (5, " \n\t", "en", "a", 3)]
    out = corpus_pipeline.run(spark, _tables(spark, tmp_path / "edge", rows)).collect()
    assert [(r.doc_id, r.n_tokens) for r in out] == [(1, 90)]
    assert corpus_pipeline.run(spark, _tables(spark, tmp_path / "empty", [])).collect() == []
