"""T6 stock-code pairs, T7 synthetic events, T8 predicate split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lograft.functions.frames import with_computed
from lograft.functions.javastr import java_trim, pair_pieces
from lograft.functions.logparse import LINE_OR_RECORD


def stockcode_pairs(df: DataFrame, value_col: str = "value", key: str = "stockcode") -> DataFrame:
    """One ``(stockcode, n=1)`` row per accepted ``stockcode=`` line.

    Headers are not checked (the counting jobs never parse them), so a message
    rejected by T5 still yields its codes.  A single split on newline-or-dashes
    gives the record lines of every record without a nested array pass;
    ``piece_pos`` is the line's position in that flat split.
    """
    others = [F.col(c) for c in df.columns if c != value_col]
    pieces = df.select(*others, F.posexplode(F.split(F.col(value_col), LINE_OR_RECORD))
                       .alias("piece_pos", "line"))
    parsed = with_computed(pieces, {"_pc": pair_pieces(F.col("line"))}, drop=["line"])
    pc = F.col("_pc")
    hit = (F.size(pc) == 2) & (F.lower(java_trim(F.get(pc, 0))) == F.lit(key))
    return (parsed.where(hit)
            .select(*others, "piece_pos",
                    F.lower(java_trim(F.get(pc, 1))).alias("stockcode"),
                    F.lit(1).alias("n")))


def synthetic_events(pairs: DataFrame, provider: Column | None = None,
                     uniqueid: Column | None = None, shard: Column | None = None,
                     shards: int = 2) -> DataFrame:
    """One ``{uniqueid, provider}`` JSON document per stock-code pair.

    Defaults follow the reference: a random UUID, ``provider`` = the current
    time formatted ``yyyy-MM-dd HH:mm:ss`` and a random shard in ``[0, shards)``.  Tests pass
    deterministic columns instead (e.g. ``pmod(<int column>, 2)``).
    """
    if provider is None:
        provider = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    uid = uniqueid if uniqueid is not None else F.expr("uuid()")
    shard_col = shard if shard is not None else F.floor(F.rand() * shards).cast("int")
    return pairs.select(
        "*",
        shard_col.cast("int").alias("shard"),
        F.to_json(F.struct(uid.alias("uniqueid"), provider.alias("provider"))).alias("payload"),
    )


def shard_split(df: DataFrame, shards: int = 2, shard_col: str = "shard",
                payload_col: str = "payload") -> list[DataFrame]:
    """One payload-only frame per shard value (disjoint, complete).

    In a stream, call this inside a single ``foreachBatch`` over a persisted
    batch so that the random shard is drawn once and the source read once.
    """
    return [df.where(F.col(shard_col) == i).select(payload_col) for i in range(shards)]
