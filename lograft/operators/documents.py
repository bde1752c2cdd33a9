"""Message -> JSON array of documents, all-or-nothing per message."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lograft.functions.frames import let, with_computed
from lograft.functions.logparse import header_fields, record_document, split_records

DOCS_TYPE = "array<map<string,string>>"


def with_documents(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Add ``first_bad INT`` (NULL = accepted), ``docs`` and ``json``.

    Validity is decided on the record array before anything is exploded, so a
    message is accepted or rejected as a unit without a regrouping shuffle.
    Headers are parsed once per message (``with_computed``); ``json`` is the
    reference's output string (NULL for rejected messages).
    """
    # The generator carries only the small header structs: copying every
    # record's text into it would cost more than splitting the message again.
    hdrs = F.transform(split_records(F.col(value_col)), header_fields)
    staged = with_computed(df, {"_hdr": hdrs})
    bad = F.filter(F.transform("_hdr", lambda h, i: F.when(~h["ok"], i)),
                   lambda i: i.isNotNull())
    staged = staged.withColumn("first_bad", F.try_element_at(bad, F.lit(1)))
    docs = let(split_records(F.col(value_col)), lambda recs: F.transform(
        recs, lambda r, i: record_document(r, F.get(F.col("_hdr"), i))))
    return (staged
            .withColumn("docs", F.when(F.col("first_bad").isNull(), docs))
            .withColumn("json", F.to_json(F.col("docs")))
            .drop("_hdr"))


def log_to_json(df: DataFrame, value_col: str = "value") -> DataFrame:
    """T4+T5: accepted messages with their JSON array (``json``)."""
    d = with_documents(df, value_col)
    return d.where(F.col("first_bad").isNull()).drop("first_bad", value_col)


def log_rejects(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Rejected messages with the position of the first bad record."""
    d = with_documents(df, value_col)
    return d.where(F.col("first_bad").isNotNull()).drop("docs", "json")


def explode_documents(docs: DataFrame, json_col: str = "json") -> DataFrame:
    """Parse the JSON arrays back to ``doc_pos, key, value`` rows."""
    parsed = docs.select(*[c for c in docs.columns if c not in (json_col, "docs")],
                         F.posexplode(F.from_json(json_col, DOCS_TYPE)).alias("doc_pos", "doc"))
    return parsed.select(*[c for c in parsed.columns if c != "doc"],
                         F.explode("doc").alias("key", "value"))
