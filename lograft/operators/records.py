"""T1-T3 as row-producing frame operators (one row per record / pair)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lograft.functions.frames import with_computed
from lograft.functions.javastr import pair_pieces, pieces_pair
from lograft.functions.logparse import header_fields, split_records


def _others(df: DataFrame, drop: str) -> list:
    return [F.col(c) for c in df.columns if c != drop]


def explode_records(df: DataFrame, value_col: str = "value") -> DataFrame:
    """One row per record: ``rec_pos INT`` (0-based) and ``record``.

    Messages whose text is only separators yield no rows, an empty message
    yields one empty record (Java split semantics).
    """
    return df.select(*_others(df, value_col),
                     F.posexplode(split_records(F.col(value_col))).alias("rec_pos", "record"))


def explode_pairs(records: DataFrame, record_col: str = "record",
                  lower_values: bool = False) -> DataFrame:
    """One row per accepted ``key=value`` line of each record.

    Adds ``line_pos INT`` (0 = header line, which is parsed like any other
    line), ``key`` (trimmed, lower-cased) and ``value`` (trimmed; lower-cased
    on request).  The generator and the filter run in the same codegen stage.
    """
    lines = records.select(*_others(records, record_col),
                           F.posexplode(F.split(F.col(record_col), "\n")).alias("line_pos", "line"))
    parsed = with_computed(lines, {"_pc": pair_pieces(F.col("line"))}, drop=["line"])
    pair = pieces_pair(F.col("_pc"), lower_value=lower_values)
    return (parsed.where(F.size("_pc") == 2)
            .select(*_others(parsed, "_pc"), pair["k"].alias("key"), pair["v"].alias("value")))


def record_headers(records: DataFrame, record_col: str = "record") -> DataFrame:
    """``header_ok``, ``logtype`` and ``uniquestr`` for every record."""
    h = header_fields(F.col(record_col))
    return records.select(*_others(records, record_col),
                          h["ok"].alias("header_ok"), h["logtype"].alias("logtype"),
                          h["uniquestr"].alias("uniquestr"))
