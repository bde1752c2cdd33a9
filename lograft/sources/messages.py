"""Build key/value log messages from the ``events`` table.

The supplied tables hold no log messages, so every message query first
renders them from event columns with plain expressions (no UDF), then runs
the real operator over the rendered text.  Oracles compute the expected
answers from the event columns directly, never by parsing the text.

Recipe (one event = one record; three consecutive events = one message):

* ``msg_id = event_id div 3``; records in ``event_id`` order joined by ten dashes
* header ``<logtype>:<HH:mm:ss.SSS>K<event_id>[1]``; logtype is the error
  label for ``event_type = 'error'`` else the normal label; the ``>`` is left
  out when ``event_id % 17 = 0`` (a bad header)
* lines, each ended by ``\\n`` (``%`` is on ``event_id`` unless stated):
  ``stockcode= S<user_id%50>\\r`` (key spelled ``StockCode`` when ``%7=0``),
  ``stockcode=x=y`` when ``%11=0``, ``stockcode=R<user_id%5>`` when ``%13=0``,
  ``action=20109|10001|999`` for ``%3 = 0|1|2``, ``code=C<user_id%9>`` when
  ``%5=0``, ``mobilecode= `` when ``%4=0`` / ``mobilecode=M<user_id>`` when
  ``%4=1``, ``uniqueid=U<user_id>`` when ``%6<3``
* ``arrival`` = 2024-01-01T00:00:00Z + first event_id * 200 ms (about 300
  events per 60 s window); ``day`` = date of the message's earliest ``ts``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lograft.functions.logparse import DASHES
from lograft.session import table_path

# The two log types used in the sample messages.
LOGTYPE_NORMAL = "正常"
LOGTYPE_ERROR = "异常"
# 2024-01-01T00:00:00Z in epoch milliseconds; arrival clock step per event.
ARRIVAL_EPOCH_MS = 1704067200000
ARRIVAL_STEP_MS = 200


def _opt(cond: Column, text: Column) -> Column:
    return F.when(cond, text).otherwise(F.lit(""))


def event_record(eid: Column, ts: Column, uid: Column, etype: Column) -> Column:
    """The record text for one event (see module docstring)."""
    s = lambda c: c.cast("string")
    header = F.concat(
        F.when(etype == "error", F.lit(LOGTYPE_ERROR)).otherwise(F.lit(LOGTYPE_NORMAL)),
        F.lit(":<"), F.date_format(ts, "HH:mm:ss.SSS"),
        _opt(eid % 17 != 0, F.lit(">")),
        F.lit("K"), s(eid), F.lit("[1]\n"),
    )
    action = (F.when(eid % 3 == 0, F.lit("20109"))
              .when(eid % 3 == 1, F.lit("10001")).otherwise(F.lit("999")))
    return F.concat(
        header,
        F.when(eid % 7 == 0, F.lit("StockCode")).otherwise(F.lit("stockcode")),
        F.lit("= S"), s(uid % 50), F.lit("\r\n"),
        _opt(eid % 11 == 0, F.lit("stockcode=x=y\n")),
        _opt(eid % 13 == 0, F.concat(F.lit("stockcode=R"), s(uid % 5), F.lit("\n"))),
        F.lit("action="), action, F.lit("\n"),
        _opt(eid % 5 == 0, F.concat(F.lit("code=C"), s(uid % 9), F.lit("\n"))),
        F.when(eid % 4 == 0, F.lit("mobilecode= \n"))
         .when(eid % 4 == 1, F.concat(F.lit("mobilecode=M"), s(uid), F.lit("\n")))
         .otherwise(F.lit("")),
        _opt(eid % 6 < 3, F.concat(F.lit("uniqueid=U"), s(uid), F.lit("\n"))),
    )


def messages_from_events(events: DataFrame, partitions: int | None = None) -> DataFrame:
    """``msg_id BIGINT, value STRING, arrival TIMESTAMP, day DATE``.

    One hash aggregate on ``msg_id``; every group holds at most three rows,
    so no key can be hot.  Records are ordered inside the group by sorting
    the collected (event_id, record) structs, not by relying on input order.
    With ``partitions`` the events are first hash-partitioned by ``msg_id``:
    the aggregate then needs no exchange of its own (one shuffle in all),
    which suits an input of few splits; a large input should leave it unset
    and keep the map-side partial aggregate before the exchange.
    """
    ev = events
    if partitions:
        ev = events.repartition(int(partitions), F.expr("event_id div 3"))
    rec = ev.select(
        F.expr("event_id div 3").alias("msg_id"),
        F.col("event_id"), F.col("ts"),
        event_record(F.col("event_id"), F.col("ts"), F.col("user_id"),
                     F.col("event_type")).alias("record"),
    )
    g = rec.groupBy("msg_id").agg(
        F.sort_array(F.collect_list(F.struct("event_id", "record"))).alias("recs"),
        F.min("event_id").alias("first_event_id"),
        F.min("ts").alias("first_ts"),
    )
    return g.select(
        "msg_id",
        F.array_join(F.transform("recs", lambda r: r["record"]), DASHES).alias("value"),
        F.timestamp_millis(F.lit(ARRIVAL_EPOCH_MS)
                           + F.col("first_event_id") * ARRIVAL_STEP_MS).alias("arrival"),
        F.to_date("first_ts").alias("day"),
    )


def load_messages(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    events = spark.read.parquet(table_path(sf_dir, "events")) \
        .select("event_id", "ts", "user_id", "event_type")
    return messages_from_events(events, partitions)
