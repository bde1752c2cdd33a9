r"""Line dedup with DataFrame functions only.

A line's key is the line stripped of ``[\x20\x09-\x0D]`` at both ends with A-Z
lower-cased.  A key of ``min_chars`` code points or more that ``min_docs``
documents hold keeps its lines in one document only (the largest or the smallest
doc_id).

1. The key hashes of a document's lines are range-partitioned by (hash, document),
   so a frequent line is split between several partitions, and the rows of one
   document under one hash stay together.  Inside a partition they are sorted by
   (hash, document, position): the first of each (hash, document) run is the one
   that counts the document; its positions are kept in order.
2. Counts and the kept document per hash are summed from one row per hash and
   partition, however frequent the line.
3. Dropped positions go back to their documents as run-length keep bitmaps
   (pairs of first line and number of lines kept), not as text.

Line identity is a pair of independent 64-bit hashes.

Defined results: a null or empty text is one empty line; rows without a doc_id
share one place after all others; rows that share a doc_id are one document when
documents are counted, and each keeps or drops its own lines; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .native import lower_ascii, no_id, strip_blanks

MIN_CHARS, MIN_DOCS = 40, 5
SALTS = 16


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def dropped_lines(rows: DataFrame, min_chars: int, min_docs: int, keep: str) -> DataFrame:
    """id, h, dropped: the sorted positions that a text (hash h) of a document loses; absent if none.

    ``rows`` has id, h and text.
    """
    line = F.col("line")
    # a key is at most as long as its line, so short lines leave before any other work
    keys = (rows.select("id", "h", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
            .where(F.length(line) >= min_chars)
            .select("id", "h", "pos", strip_blanks(line).alias("line"))
            .where(F.length(line) >= min_chars)
            .select("id", "h", "pos", lower_ascii(line).alias("line"))
            .select("id", "h", "pos", F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(min_chars), "line").alias("k2")))
    # range partitioning by (k1, k2, id) already brings these rows together: no further exchange
    runs = (keys.repartitionByRange("k1", "k2", "id")
            .sortWithinPartitions("k1", "k2", "id", "h", "pos")
            .groupBy("k1", "k2", "id").agg(F.collect_list(F.struct("h", "pos")).alias("at")))
    # read twice, so stored: the lines are not split and hashed again
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "line-runs")
    runs.write.parquet(path)
    runs = spark.read.schema(runs.schema).parquet(path)
    chosen = F.max("id") if keep == "last" else F.min("id")
    frequent = (runs.groupBy("k1", "k2").agg(F.count("*").alias("n_docs"), chosen.alias("keeper"))
                .where(F.col("n_docs") >= min_docs).select("k1", "k2", "keeper"))
    # a line of a third of all documents meets its keeper in SALTS places
    salted = frequent.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (runs.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(salted, ["k1", "k2", "salt"])
            .where(F.col("id") != F.col("keeper"))
            .select("id", F.explode("at").alias("at")).select("id", "at.h", "at.pos")
            .groupBy("id", "h").agg(F.sort_array(F.collect_set("pos")).alias("dropped")))


def keep_runs(dropped: Column, n_lines: Column) -> Column:
    """The kept lines as (first, n) pairs: the gaps between dropped positions."""
    before = F.concat(F.array(F.lit(-1)), dropped)
    after = F.concat(dropped, F.array(n_lines))
    gaps = F.zip_with(before, after, lambda a, z: F.struct((a + 1).alias("first"), (z - a - 1).alias("n")))
    return F.filter(gaps, lambda r: r["n"] > 0)


def kept_text(text: Column, keep: Column) -> Column:
    """Apply a keep bitmap."""
    lines = lines_of(text)
    return F.array_join(F.flatten(F.transform(keep, lambda r: F.slice(lines, r["first"] + 1, r["n"]))), "\n")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, keep: str = "last") -> DataFrame:
    """row (the input row as a struct), n_lines, n_dropped and keep_runs, the keep bitmap (null: all lines stay)."""
    own = docs.select(F.struct("*").alias("row"), no_id(F.col("doc_id")).alias("id"),
                      F.xxhash64("text").alias("h"), F.col("text").alias("text"))
    dropped = dropped_lines(own.select("id", "h", "text"), min_chars, min_docs, keep)
    n_lines = F.size(lines_of(F.col("row.text")))
    return (own.drop("text").join(dropped, ["id", "h"], "left")
            .select("row", n_lines.cast("long").alias("n_lines"),
                    F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                    keep_runs(F.col("dropped"), n_lines).alias("keep_runs")))


def kept(result: DataFrame) -> DataFrame:
    """``dedup_lines`` with the kept text of every row."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return result.withColumn("kept_text", F.when(F.col("keep_runs").isNull(), text)
                             .otherwise(kept_text(F.col("row.text"), F.col("keep_runs"))))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256, keep_runs per row."""
    return kept(dedup_lines(docs)).select("row.doc_id", "n_lines", "n_dropped",
                                          F.sha2("kept_text", 256).alias("kept_sha256"), "keep_runs")


ORACLE_SQL = """
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, line, pos, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line),
frequent AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT k.doc_id, k.line, k.pos, f.keeper IS NOT NULL AND f.keeper <> k.doc_id AS gone
  FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
