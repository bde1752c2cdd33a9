"""URL filters: host and path rules, then a block list held as a Bloom filter cascade.

A cascade answers membership exactly for a closed universe of keys, here the
hosts of the corpus.  Its first Bloom filter encodes the listed keys.  The keys
of the universe that pass it wrongly are encoded by the second filter, the
listed keys that pass that one wrongly by the third, and so on until no key
passes wrongly.  A key is judged by the first filter that turns it away.

Keys are hashed into shards of bounded size, each with a cascade of its own,
built in one task.  Cascades of at most ``broadcast_bytes`` together are sent to
all tasks; larger ones stay with their shards, and the rows come to them dealt
over salts, so a host with a third of all pages is spread out.

Defined results: a null url, or one without ``://``, has an empty host and path,
fits no rule and is not listed; the longest rule wins, of equally long ones the
first in alphabetical order; repeated rows are judged each; a null page_id is
kept; extra columns are ignored; an empty table gives an empty result, an empty
list blocks nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ..session import scratch_path
from . import rolling as R
from .native import lower_ascii

#: (verdict, host, path).  Fixed values.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: A host is listed if one of its labels is among these.  Fixed values.
LISTED_LABELS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
SHARD_KEYS = 1 << 20
BROADCAST_BYTES = 32 << 20


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def first_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = None
    for what, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fit = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = (F.when if rule is None else rule.when)(fit, F.lit(h + p))
        verdict = (F.when if verdict is None else verdict.when)(fit, F.lit(what))
    return rule, verdict


class Cascade:
    """Alternating Bloom filters over pairs of 64-bit key hashes."""

    def __init__(self, levels: list[tuple[int, int, np.ndarray]]):
        self.levels = levels  # (number of hashes, bits, packed bits)

    @staticmethod
    def _places(a: np.ndarray, b: np.ndarray, level: int, n_hashes: int, bits: int) -> np.ndarray:
        salt = R.mix(np.array([level], dtype=np.uint64))
        a, b = R.mix(a ^ salt), R.mix(b + salt) | np.uint64(1)
        steps = np.arange(n_hashes, dtype=np.uint64)
        return R.mix(a[:, None] + steps * b[:, None]) % np.uint64(bits)

    @classmethod
    def _filter(cls, a, b, level: int, rate: float) -> tuple[int, int, np.ndarray]:
        if not len(a):
            return 1, 0, np.zeros(0, dtype=np.uint8)
        n_hashes = max(1, math.ceil(-math.log2(rate)))
        bits = math.ceil(n_hashes * len(a) / math.log(2)) + 8
        mask = np.zeros(bits, dtype=bool)
        mask[cls._places(a, b, level, n_hashes, bits).ravel()] = True
        return n_hashes, bits, np.packbits(mask)

    def _passes(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n_hashes, bits, packed = self.levels[level]
        if not bits or not len(a):
            return np.zeros(len(a), dtype=bool)
        at = self._places(a, b, level, n_hashes, bits)
        return ((packed[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1).all(axis=1)

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray, listed: np.ndarray) -> "Cascade":
        out = cls([])
        encode, other = np.flatnonzero(listed), np.flatnonzero(~listed)
        rate = min(0.5, math.sqrt(0.5) * max(len(encode), 1) / max(len(other), 1))
        while True:
            level = len(out.levels)
            if level > 200:
                raise ValueError("two keys with equal hashes, one of them listed")
            out.levels.append(cls._filter(a[encode], b[encode], level, rate))
            wrong = other[out._passes(level, a[other], b[other])]
            if not len(wrong):
                return out
            encode, other, rate = wrong, encode, 0.5

    def holds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Exact for keys of the universe."""
        result = np.full(len(a), len(self.levels) % 2 == 1)
        left = np.arange(len(a))
        for level in range(len(self.levels)):
            passed = self._passes(level, a[left], b[left])
            result[left[~passed]] = level % 2 == 1
            left = left[passed]
        return result

    def dump(self) -> list[dict]:
        return [{"k": k, "bits": bits, "data": data.tobytes()} for k, bits, data in self.levels]

    @classmethod
    def load(cls, levels: list) -> "Cascade":
        return cls([(x["k"], x["bits"], np.frombuffer(x["data"], dtype=np.uint8)) for x in levels])


_LEVELS = pa.list_(pa.struct([("k", pa.int64()), ("bits", pa.int64()), ("data", pa.binary())]))
_SQL = "shard int, levels array<struct<k:bigint,bits:bigint,data:binary>>"


def _hashes(table) -> tuple[np.ndarray, np.ndarray]:
    return np.asarray(table.column("key_a")).view(np.uint64), np.asarray(table.column("key_b")).view(np.uint64)


def _build(table: pa.Table) -> pa.Table:
    a, b = (x.copy() for x in _hashes(table))
    cascade = Cascade.build(a, b, np.asarray(table["listed"]))
    return pa.table({"shard": table["shard"].slice(0, 1), "levels": pa.array([cascade.dump()], _LEVELS)})


def with_shard(rows: DataFrame, key: str, shards: int) -> DataFrame:
    rows = rows.withColumn("key_a", F.xxhash64(key)).withColumn("key_b", F.xxhash64(F.lit(1), key))
    return rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(2), key), F.lit(shards)).cast("int"))


def mark_listed(rows: DataFrame, key: str, universe: DataFrame, shard_keys: int = SHARD_KEYS,
                broadcast_bytes: int = BROADCAST_BYTES, salts: int = 64) -> DataFrame:
    """``rows`` with ``listed``.  ``universe`` has every key of ``rows`` once, as ``key``, and whether it is listed."""
    spark = rows.sparkSession
    shards = max(1, -(-universe.count() // shard_keys))
    path = scratch_path(spark, "cascades")
    with_shard(universe, "key", shards).groupBy("shard").applyInArrow(_build, _SQL).write.parquet(path)
    stored = spark.read.schema(_SQL).parquet(path)
    size = stored.select(F.sum(F.aggregate("levels", F.lit(0).cast("long"),
                                           lambda s, x: s + F.octet_length(x["data"])))).first()[0] or 0
    rows = with_shard(rows, key, shards)
    schema = StructType([*rows.schema.fields, StructField("listed", BooleanType())])

    def judged(table, cascades: dict):
        a, b = _hashes(table)
        shard, out = np.asarray(table.column("shard")), np.zeros(table.num_rows, dtype=bool)
        for s in np.unique(shard):
            at = np.flatnonzero(shard == s)
            out[at] = cascades[int(s)].holds(a[at], b[at])
        return table.append_column("listed", pa.array(out))

    if size <= broadcast_bytes:
        sent = spark.sparkContext.broadcast({r.shard: [x.asDict() for x in r.levels] for r in stored.collect()})

        def look_up(batches):
            cascades = {s: Cascade.load(levels) for s, levels in sent.value.items()}
            for batch in batches:
                if batch.num_rows:
                    yield from judged(pa.Table.from_batches([batch]), cascades).to_batches()

        return rows.mapInArrow(look_up, schema).drop("key_a", "key_b", "shard")

    def look_up_here(mine: pa.Table, cascade: pa.Table) -> pa.Table:
        if not mine.num_rows:
            return mine.append_column("listed", pa.array([], pa.bool_()))
        return judged(mine, {cascade["shard"][0].as_py(): Cascade.load(cascade["levels"][0].as_py())})

    rows = rows.withColumn("salt", (F.rand(7) * salts).cast("int"))
    schema = StructType([*rows.schema.fields, StructField("listed", BooleanType())])
    spread = stored.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (rows.groupBy("shard", "salt").cogroup(spread.groupBy("shard", "salt")).applyInArrow(look_up_here, schema)
            .where(F.col("listed").isNotNull()).drop("key_a", "key_b", "shard", "salt"))


def filter_urls(pages: DataFrame, rules=RULES, labels=LISTED_LABELS, **limits) -> DataFrame:
    """page_id, host, path, rule, verdict, listed per page."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    listed = F.arrays_overlap(F.split("host", r"\."), F.array(*[F.lit(x) for x in labels]))
    universe = rows.select("host").distinct().select(F.col("host").alias("key"), listed.alias("listed"))
    marked = mark_listed(rows, "host", universe, **limits)
    rule, verdict = first_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return marked.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "listed")


ORACLE_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM p)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN list_has_any(string_split(host, '.'), ['ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets',
                                                'spam-farm']) THEN 'block'
    ELSE 'allow' END AS verdict
FROM r
"""
