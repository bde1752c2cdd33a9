"""Search-event normalisation (the flagship transform)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lograft.functions.frames import with_computed
from lograft.functions.logparse import last_key_value

# The whitelisted keys and the two accepted action codes.
SEARCH_KEYS = ["action", "stockcode", "mobilecode", "uniqueid", "code"]
ACTION_SEARCH = "20109"
ACTION_CODE = "10001"


def normalize_search(records: DataFrame, record_col: str = "record",
                     day: Column | None = None) -> DataFrame:
    """One normalised row per record whose ``action`` is 20109 or 10001.

    Per record: keep the whitelisted keys (values lower-cased, last accepted
    line wins, see ``last_key_value``); for 10001 a non-empty ``code``
    replaces ``stockcode`` and is removed; ``usersign`` is ``uniqueid`` when ``mobilecode`` is empty or
    absent and ``uniqueid`` non-empty, else ``mobilecode`` (possibly ``""``);
    ``total_number = 1``; ``day`` defaults to the current date.  NULL means
    "absent" and is omitted from ``json``.
    """
    day = day if day is not None else F.current_date()
    # One codegen'd regex per whitelisted key finds its last accepted line;
    # the five values are produced once per record behind a generator.
    kv = F.struct(*[F.lower(last_key_value(F.col(record_col), k)).alias(k) for k in SEARCH_KEYS])
    staged = with_computed(records, {"_kv": kv}, drop=[record_col])
    staged = staged.select(*[c for c in staged.columns if c != "_kv"],
                           *[F.col("_kv")[k].alias(f"_{k}") for k in SEARCH_KEYS])
    action, code = F.col("_action"), F.col("_code")
    mobile, unique = F.col("_mobilecode"), F.col("_uniqueid")
    code_wins = (action == ACTION_CODE) & (F.coalesce(code, F.lit("")) != "")
    produced = {"stockcode", "code", "usersign", "total_number", "day", "json"}
    out = staged.where(action.isin(ACTION_SEARCH, ACTION_CODE)).select(
        *[c for c in staged.columns if not c.startswith("_") and c not in produced],
        F.when(code_wins, code).otherwise(F.col("_stockcode")).alias("stockcode"),
        F.when(code_wins, F.lit(None).cast("string")).otherwise(code).alias("code"),
        F.when((F.coalesce(mobile, F.lit("")) == "") & (F.coalesce(unique, F.lit("")) != ""),
               unique).otherwise(F.coalesce(mobile, F.lit(""))).alias("usersign"),
        F.lit(1).alias("total_number"),
        day.cast("date").alias("day"),
    )
    return out.withColumn("json", F.to_json(F.struct(
        "stockcode", "code", "usersign", "total_number", "day")))
