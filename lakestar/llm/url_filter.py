"""URL filtering with a cascade of Bloom filters, in DataFrame operations only.

Level 0 holds the listed keys.  Level 1 holds the keys of the corpus that are
not listed but pass level 0, level 2 the listed keys that pass level 1, and so
on until a level has no false positive among the corpus's keys.  The first
level that rejects a key then decides exactly whether it is listed, for every
key of the corpus, without a join.

The keys of a url are its host and all its parent domains, so a listed domain
covers its subdomains.  A filter is built from SQL's bitmap aggregates, one
32,768-bit bitmap per bucket.  A cascade whose first level would need more
than ``MAX_BITS`` bits is split by a hash of the key into several, each with
its own literals and its own pass over the urls.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
HASHES = 4
BUCKET = 32_768                 # bits of one SQL bitmap
MAX_BITS = 1 << 26              # of a filter: 8 MB in the plan


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or
    without ``://``."""
    text = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(text, "://([^/?#]*)", 1)
    path = F.regexp_extract(text, "://[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def keys_of(host: Column) -> Column:
    """A host and its parent domains; none for an empty host."""
    labels = F.split(host, "\\.")
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(labels)),
                    lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))


def _positions(key: Column, level: int, bits: int) -> list[Column]:
    """Bits of a key, from 1, as SQL's bitmaps count."""
    return [F.pmod(F.xxhash64(key, F.lit(level * HASHES + h)), F.lit(bits)) + 1 for h in range(HASHES)]


def _build(keys: DataFrame, level: int, n: int) -> tuple[int, bytes]:
    buckets = max(1, -(-n * BITS_PER_KEY // BUCKET))
    bits = buckets * BUCKET
    maps = keys.select(F.explode(F.array(*_positions(F.col("key"), level, bits))).alias("p")) \
        .groupBy(F.bitmap_bucket_number("p").alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bitmap"))
    out = bytearray(bits // 8)
    for row in maps.collect():                      # at most MAX_BITS / BUCKET rows of 4 KB
        out[(row.bucket - 1) * BUCKET // 8:row.bucket * BUCKET // 8] = row.bitmap
    return bits, bytes(out)


def _passes(key: Column, level: int, filter_: tuple[int, bytes]) -> Column:
    bits, raw = filter_
    blob = F.lit(raw)

    def bit(p: Column) -> Column:
        byte = F.conv(F.hex(F.substring(blob, (F.floor((p - 1) / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, F.pmod(p - 1, F.lit(8)).cast("int")) == 1
    return reduce(lambda a, b: a & b, [bit(p) for p in _positions(key, level, bits)])


class Cascade:
    """Exact membership of the keys of one universe."""

    def __init__(self, levels: list[tuple[int, bytes]]):
        self.levels = levels

    def listed(self, key: Column) -> Column:
        """The first level that rejects a key decides: even levels hold
        listed keys, odd ones the others."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in range(len(self.levels) - 1, -1, -1):
            answer = F.when(_passes(key, level, self.levels[level]), answer).otherwise(F.lit(level % 2 == 1))
        return answer


def build(universe: DataFrame) -> Cascade:
    """Cascade for a table ``(key, listed)`` of distinct keys."""
    sides = {True: universe.where("listed"), False: universe.where("not listed")}
    levels: list[tuple[int, bytes]] = []
    while True:
        side = len(levels) % 2 == 0
        mine = sides[side]
        n = mine.count()
        if not n:
            return Cascade(levels)
        levels.append(_build(mine, len(levels), n))
        sides[not side] = sides[not side].where(_passes(F.col("key"), len(levels) - 1, levels[-1]))


def universe(urls: DataFrame, listed: DataFrame, url: str = "url") -> DataFrame:
    """All keys of the corpus and of the list, once each, with whether they
    are listed."""
    host, _ = host_and_path(F.col(url))
    corpus = urls.select(host.alias("host")).where("host <> ''").distinct() \
        .select(F.explode(keys_of(F.col("host"))).alias("key"), F.lit(False).alias("listed"))
    given = listed.select(F.col("key"), F.lit(True).alias("listed")).where("key is not null and key <> ''")
    return corpus.unionByName(given).groupBy("key").agg(F.max("listed").alias("listed"))


def flag(urls: DataFrame, listed: DataFrame, url: str = "url", max_bits: int = MAX_BITS) -> DataFrame:
    """Adds ``host, path, in_list``: whether the host or a parent domain is
    listed.

    A url that is null, empty or has no ``://`` has an empty host and path
    and is not listed.  Null and empty list entries are ignored, repeated
    ones count once; an empty list lists nothing.  Rows are kept as they are,
    repeated ones too; columns called host, path or in_list are replaced.
    """
    keys = universe(urls, listed, url).checkpoint()
    host, path = host_and_path(F.col(url))
    out = urls.withColumns({"host": host, "path": path})
    n = keys.where("listed").count()
    shards = max(1, -(-n * BITS_PER_KEY // max_bits))
    out = out.withColumn("in_list", F.lit(False))
    for shard in range(shards):
        mine = F.pmod(F.xxhash64("key", F.lit(-1)), F.lit(shards)) == shard
        cascade = build(keys.where(mine) if shards > 1 else keys)
        if not cascade.levels:
            continue
        of_shard = keys_of(F.col("host")) if shards == 1 else F.filter(
            keys_of(F.col("host")), lambda k: F.pmod(F.xxhash64(k, F.lit(-1)), F.lit(shards)) == shard)
        out = out.withColumn("in_list", F.col("in_list") | F.exists(of_shard, cascade.listed))
        if shards > 1:
            out = out.checkpoint()          # one shard's literals at a time
    return out


Rule = tuple[str, str, str]     # verdict, host, path prefix


def judge(urls: DataFrame, listed: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """Adds ``host, path, rule, verdict``: the longest rule whose host is the
    url's or a parent domain and whose path begins the url's path; without
    one (rule null), ``block`` if the url is listed, else ``allow``."""
    out = flag(urls, listed, url)
    rule = F.lit(None).cast("string")
    verdict = F.when(F.col("in_list"), "block").otherwise("allow")
    for decision, host, path in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, host + path).otherwise(rule)
        verdict = F.when(fits, decision).otherwise(verdict)
    return out.withColumns({"rule": rule, "verdict": verdict}).drop("in_list")
