"""A1-A5: windowed counts, latest-window upsert, daily sum rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lograft.operators.merge import check_constraints

WINDOW_60S = "60 seconds"


def count_by_window(pairs: DataFrame, time_col: str = "arrival", key_col: str = "stockcode",
                    measure: str = "n", duration: str = WINDOW_60S) -> DataFrame:
    """A1: keyed tumbling-window sum, windows aligned to the epoch.

    Catalyst plans a partial (map-side) hash aggregate before the exchange,
    so a hot key costs one row per task and window, not one per event.
    """
    return (pairs.groupBy(F.window(time_col, duration).alias("w"), F.col(key_col))
            .agg(F.sum(measure).cast("bigint").alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    key_col, "n"))


def latest_window_count(counts: DataFrame, key_col: str = "stockcode") -> DataFrame:
    """A2 (K3's effect): per key, the count of its most recent window.

    ``max_by`` is an ordinary aggregate, so it is combined map-side too.
    """
    return counts.groupBy(key_col).agg(
        F.max_by("n", "window_end").alias("n"),
        F.max("window_end").alias("window_end"))


def daily_sum(df: DataFrame, key_col: str, out_key: str | None = None,
              day_col: str = "day", measure: str = "total_number") -> DataFrame:
    """A3/A4/A5 core: ``SUM(measure)`` by (key, day); missing measure = 0."""
    out_key = out_key or key_col
    return (df.groupBy(F.col(key_col).alias(out_key), F.col(day_col).alias("day"))
            .agg(F.sum(F.coalesce(F.col(measure).cast("bigint"), F.lit(0))).alias("total_number")))


def hot_stock_daily(search: DataFrame, max_bytes: int = 128) -> DataFrame:
    """A3: daily hot-code table ``(stock_code, day, total_number)``.

    Rows rejected by the table's constraints (NULL code, code longer than
    VARCHAR(128) bytes) are left out; see ``check_constraints`` for them.
    """
    loaded = search.select(F.col("stockcode").alias("stock_code"), "day", "total_number")
    good = check_constraints(loaded, not_null=["stock_code", "day"],
                             max_bytes={"stock_code": max_bytes})
    return daily_sum(good.where(F.col("reject_reason").isNull()), "stock_code")


def active_user_daily(search: DataFrame, max_bytes: int = 128) -> DataFrame:
    """A4: daily active-user table ``(usersign, day, total_number)``."""
    loaded = search.select("usersign", "day", "total_number")
    good = check_constraints(loaded, not_null=["usersign", "day"],
                             max_bytes={"usersign": max_bytes})
    return daily_sum(good.where(F.col("reject_reason").isNull()), "usersign")


def sum_merge(stored: DataFrame, batch: DataFrame, keys: list[str],
              measure: str = "total_number") -> DataFrame:
    """A5: merge a batch into stored sums (SUM on merge, DEFAULT 0).

    The batch is pre-aggregated before the union so that only one row per key
    from each side reaches the final aggregate's exchange.
    """
    pre = batch.groupBy(*keys).agg(
        F.sum(F.coalesce(F.col(measure).cast("bigint"), F.lit(0))).alias(measure))
    both = stored.select(*keys, F.col(measure).cast("bigint").alias(measure)).unionByName(pre)
    return both.groupBy(*keys).agg(
        F.sum(F.coalesce(F.col(measure), F.lit(0))).alias(measure))
