"""X1 event-time window count and X2 running word count (second tier)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lograft.functions.javastr import java_split


def event_count(df: DataFrame, time_col: str, key_col: str, duration: str = "5 minutes") -> DataFrame:
    """Event-time tumbling count per key."""
    return (df.groupBy(F.window(time_col, duration).alias("w"), F.col(key_col))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    key_col, "n"))


def word_count(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Count words over whole texts, one line at a time (a socket source
    delivers lines).  Each line is split on single spaces the Java way:
    trailing empties dropped, inner and leading empties counted, an empty
    line is one empty word, a line of spaces has none.  Partial aggregation
    keeps a very frequent word from piling up in one task.
    Lines follow the same Java split rule (trailing empty lines dropped)."""
    lines = df.select(F.explode(java_split(F.col(text_col), "\n")).alias("line"))
    words = lines.select(F.explode(java_split(F.col("line"), " ")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
