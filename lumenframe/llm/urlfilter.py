"""URL filters: longest-match host and path rules, then a Bloom filter cascade over listed domains.

Level 0 encodes the listed keys; each next level encodes the keys of the corpus's whole key universe
that the level before lets through wrongly, until none is left. Membership of any key of the universe
is then exact, tested against bit arrays that scalar subqueries put into the plan: no join.

Edge cases: a null url, or one without ``://``, has an empty host and path, fits no rule and is not
listed (allow); an empty table or an empty list gives no level (nothing is listed); repeated keys
count once; a host of any length has at most as many keys as the longest listed name has labels; an input
column named as an added one gives way to it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage, table

#: (verdict, host, path) rules; the longest that fits a url decides.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Listed domains; a host is blocked if it or a domain above it is listed.
LISTED = tuple(f"{name}.example.{tld}" for name in ("adult-x", "casino-win", "cheap-pills") for tld in ("com", "net", "org"))
#: Bits of one shard of a level, and of all levels: what a driver may hand to every task (64 MiB).
SHARD_BITS, MAX_BITS = 1 << 27, 1 << 29


def host_path(url) -> tuple[F.Column, F.Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)


def rule_of(host, path, rules: Sequence[tuple[str, str, str]] = RULES) -> F.Column:
    """The longest rule that fits as struct(rule, verdict), or null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        chosen = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def keys_of(host, labels: int) -> F.Column:
    """The domains of a host with at most ``labels`` labels, itself included."""
    parts = F.split(host, r"\.")
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))), lambda i: F.array_join(F.slice(parts, -i, i), ".")))


class Cascade:
    """Levels of (shards of words, bits a shard, hashes); a shard is a one-row frame with an array of longs."""

    def __init__(self, levels: list[tuple[list[DataFrame], int, int]], counts: list[int]):
        self.levels, self.counts = levels, counts

    @staticmethod
    def _shard(key, level: int, shards: int) -> F.Column:
        return F.pmod(F.xxhash64(F.lit("shard"), key, F.lit(level)), F.lit(shards)).cast("int")

    @staticmethod
    def _bit(key, level: int, n_bits: int, i: int) -> F.Column:
        a, b = F.xxhash64(key, F.lit(level)), F.xxhash64(F.lit(~level), key)
        return F.pmod(F.pmod(a, F.lit(n_bits)) + i * (F.pmod(b, F.lit(n_bits - 1)) + 1), F.lit(n_bits))

    @classmethod
    def build(cls, listed: DataFrame, universe: DataFrame, shard_bits: int = SHARD_BITS, max_bits: int = MAX_BITS) -> Cascade | None:
        """``listed`` and ``universe`` have a column ``key``. Levels are staged; their counts steer the loop.

        A level of more than ``shard_bits`` is dealt to shards by key. None if the levels together would
        take more than ``max_bits``: too much to hand to every task.
        """
        keys = universe.select("key", F.lit(0).alias("listed")).unionByName(listed.select("key", F.lit(1).alias("listed")))
        keys = stage(keys.where("key IS NOT NULL").groupBy("key").agg(F.max("listed").alias("listed")), "cascade-keys")
        n_in, n_out = keys.agg(F.coalesce(F.sum("listed"), F.lit(0)), F.coalesce(F.sum(1 - F.col("listed")), F.lit(0))).first()
        levels: list[tuple[list[DataFrame], int, int]] = []
        counts: list[int] = []
        n, encoded, other, taken = n_in, keys.where("listed = 1"), keys.where("listed = 0"), 0
        while n:
            rate = min(0.5, max(1e-6, math.sqrt(0.5) * n_in / max(1, n_out))) if not levels else 0.5
            needed, depth = n * -math.log(rate) / math.log(2) ** 2, len(levels)
            shards = math.ceil(needed / shard_bits)
            n_bits = max(64, 64 * math.ceil(needed / shards / 64))
            taken += n_bits * shards
            if taken > max_bits:
                return None
            n_hashes = max(1, round(-math.log2(rate)))
            bits = encoded.select(cls._shard(F.col("key"), depth, shards).alias("s"), F.explode(F.array(*(cls._bit(F.col("key"), depth, n_bits, i) for i in range(n_hashes)))).alias("bit"))
            words = bits.select("s", F.expr("bit div 64").alias("w"), F.expr("shiftleft(1L, cast(bit % 64 as int))").alias("v"))
            # every word of every shard once, so that the sorted list is the array
            none = encoded.sparkSession.range(shards * (n_bits // 64)).select(F.expr(f"cast(id div {n_bits // 64} as int)").alias("s"), F.expr(f"id % {n_bits // 64}").alias("w"), F.lit(0).cast("long").alias("v"))
            words = words.unionByName(none).groupBy("s", "w").agg(F.bit_or("v").alias("v"))
            words = stage(words.groupBy("s").agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "v"))), lambda x: x.v).alias("words")), "cascade-level")
            levels.append(([words.where(F.col("s") == k).select("words") for k in range(shards)], n_bits, n_hashes))
            counts.append(n)
            through = stage(other.where(cls._passes(F.col("key"), levels[-1], depth)), "cascade-through")
            n = through.count()
            encoded, other = through, encoded
        return cls(levels, counts)

    @classmethod
    def _passes(cls, key, level: tuple[list[DataFrame], int, int], depth: int) -> F.Column:
        shards, n_bits, n_hashes = level
        at, test = cls._shard(key, depth, len(shards)), F.lit(True)
        for i in range(n_hashes):
            bit = cls._bit(key, depth, n_bits, i)
            place = F.floor(bit / 64).cast("int")
            word = F.get(shards[0].scalar(), place)
            for k, words in enumerate(shards[1:], 1):
                word = F.when(at == k, F.get(words.scalar(), place)).otherwise(word)
            test = test & (F.getbit(word, F.pmod(bit, F.lit(64)).cast("int")) == 1)
        return test

    def contains(self, key) -> F.Column:
        """Whether a key of the universe is listed: the first level that stops it tells."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for depth in reversed(range(len(self.levels))):
            answer = F.when(~self._passes(key, self.levels[depth], depth), F.lit(depth % 2 == 1)).otherwise(answer)
        return answer


ADDED = ("_host", "_path", "_rule", "_listed", "_verdict")


def filter_urls(pages: DataFrame, listed: DataFrame | Sequence[str] = LISTED, rules: Sequence[tuple[str, str, str]] = RULES, max_bits: int = MAX_BITS) -> DataFrame:
    """Add ``_host``, ``_path``, ``_rule``, ``_listed`` and ``_verdict`` to a frame with a column url.

    ``listed`` are domains, or a table of them with a column ``key``. A list whose levels would take more
    than ``max_bits`` is looked up by hosts: the distinct ones join it, and the pages join them, salted.
    """
    spark = pages.sparkSession
    if not isinstance(listed, DataFrame):
        listed = spark.createDataFrame([(k,) for k in listed], "key string")
    host, path = host_path(F.col("url"))
    p = pages.drop(*ADDED).withColumns({"_host": host, "_path": path})
    labels = listed.agg(F.coalesce(F.max(F.size(F.split("key", r"\."))), F.lit(1))).first()[0]
    hosts = stage(p.select("_host").distinct(), "hosts")
    universe = hosts.select(F.explode(keys_of(F.col("_host"), labels)).alias("key")).distinct()
    cascade = Cascade.build(listed, universe, max_bits=max_bits)
    if cascade is None:
        p = _joined(p, hosts, listed, labels)
    else:
        # subqueries can't stand inside a lambda: one test a number of labels
        found, keys = F.lit(False), keys_of(F.col("_host"), labels)
        for i in range(labels if cascade.levels else 0):
            found = found | (F.get(keys, F.lit(i)).isNotNull() & cascade.contains(F.coalesce(F.get(keys, F.lit(i)), F.lit(""))))
        p = p.withColumn("_listed", found)
    p = p.withColumn("_rule", rule_of(F.col("_host"), F.col("_path"), rules))
    return p.withColumn("_verdict", F.coalesce(F.col("_rule.verdict"), F.when(F.col("_listed"), "block").otherwise("allow"))).select(*(c for c in pages.columns if c not in ADDED), *ADDED)


def _joined(p: DataFrame, hosts: DataFrame, listed: DataFrame, labels: int, salts: int = 64) -> DataFrame:
    """``p`` with ``_listed`` by joins, for lists too large for a cascade."""
    keys = hosts.select("_host", F.explode(keys_of(F.col("_host"), labels)).alias("key"))
    hit = stage(keys.join(listed.select("key").distinct(), "key", "left_semi").select("_host").distinct(), "listed-hosts")
    hit = hit.select(F.col("_host").alias("_hit"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    spread = F.pmod(F.xxhash64("url"), F.lit(salts)).cast("int")
    out = p.join(hit, (F.col("_host") == F.col("_hit")) & (spread == F.col("_salt")), "left")
    return out.withColumn("_listed", F.col("_hit").isNotNull()).drop("_hit", "_salt")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
    return out.select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule.rule").alias("rule"), F.col("_verdict").alias("verdict"))


def _op3_sql() -> str:
    cases = {"rule": "", "verdict": ""}
    for verdict, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        fits = f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND path LIKE '{p}%' THEN "
        cases["rule"] += f"{fits}'{h}{p}' "
        cases["verdict"] += f"{fits}'{verdict}' "
    hit = " OR ".join(f"host = '{k}' OR host LIKE '%.{k}'" for k in LISTED)
    return f"""
    WITH r AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM r)
    SELECT page_id, host, path, CASE {cases['rule']} ELSE NULL END AS rule,
      CASE {cases['verdict']} WHEN {hit} THEN 'block' ELSE 'allow' END AS verdict FROM p"""


OP3_SQL = _op3_sql()
