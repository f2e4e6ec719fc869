"""URL filters by a cascade of Bloom filters.

The keys that a list may hold for a URL are the suffixes of its host with the
prefixes of its path (``example.com/en/``).  The first filter encodes the
listed keys, the second the keys of the corpus that the first wrongly lets
through, the third the listed keys that the second wrongly catches, and so on
until no key is wrong.  As the levels are built over the complete key universe
of the corpus, membership of its keys is exact, and it is tested in the row,
without a join.

Built of DataFrame operations only; the filters are binary literals of the
plan; each level encodes at most `MOST_LISTED` keys, listed or wrongly let
through.  Lists that need more on any level are joined.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.llm.store import cut

#: Keys that a filter may encode (a byte each); beyond that, a join is used.
MOST_LISTED = 500_000
BITS_PER_KEY, HASHES = 8, 3
MOST_LEVELS = 40


@dataclass(frozen=True)
class Bloom:
    words: bytes
    bits: int
    level: int

    def may_hold(self, key: Column) -> Column:
        data = F.lit(bytearray(self.words))
        out = F.lit(True)
        for place in _places(key, self.level, self.bits):
            byte = F.conv(F.hex(F.substring(data, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10)
            out = out & (F.shiftright(byte.cast("int"), 0).bitwiseAND(
                F.element_at(F.array(*[F.lit(1 << b) for b in range(8)]),
                             (place.bitwiseAND(F.lit(7)) + 1).cast("int"))) != 0)
        return out


def _places(key: Column, level: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level * HASHES + i)), F.lit(bits).cast("long")) for i in range(HASHES)]


def _build(keys: DataFrame, n: int, level: int) -> Bloom:
    """Filter of the column ``key``; n is its row count, at most MOST_LISTED."""
    bits = 64 * max(1, -(-n * BITS_PER_KEY // 64))
    place = F.explode(F.array(*_places(F.col("key"), level, bits)))
    rows = (keys.select(place.alias("p"))
            .groupBy(F.shiftright("p", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("set")).collect())
    data = bytearray(bits // 8)
    for r in rows:  # at most one row per 64 bits of the filter
        data[8 * r["word"]:8 * r["word"] + 8] = struct.pack("<q", r["set"])
    return Bloom(bytes(data), bits, level)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Bloom, ...]

    def holds(self, key: Column) -> Column:
        """Exact membership of a key of the universe."""
        out: Column | None = None
        for bloom in reversed(self.levels):
            out = bloom.may_hold(key) if out is None else bloom.may_hold(key) & ~out
        return F.lit(False) if out is None else out


def cascade(listed: DataFrame, universe: DataFrame) -> Cascade | None:
    """Cascade over ``listed`` (column key, distinct) for the keys of
    ``universe`` (column key); None if a level had to encode more than
    MOST_LISTED keys, as the errors of the first one grow with the universe.

    Listed keys outside the universe are left out first.  Each level is built
    from the errors of the one before; their numbers fall geometrically.
    """
    inside = cut(universe.join(listed, "key", "left_semi"), "listed")
    outside = universe.join(listed, "key", "left_anti")
    levels: list[Bloom] = []
    encode, check = inside, outside
    for level in range(MOST_LEVELS):
        n = encode.count()
        if n == 0:
            return Cascade(tuple(levels))
        if n > MOST_LISTED:
            return None
        bloom = _build(encode, n, level)
        levels.append(bloom)
        wrong = cut(check.where(bloom.may_hold(F.col("key"))), f"wrong-{level}")
        encode, check = wrong, encode
    raise RuntimeError("cascade: errors did not vanish")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with
    A-Z in lower case; empty without ``://``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _depths(keys: DataFrame) -> tuple[int, int]:
    """Most host labels and path parts of any listed key."""
    host, path = F.substring_index("key", "/", 1), F.expr("substring(key, instr(key, '/'))")
    row = keys.agg(F.max(F.size(F.split(host, r"\."))), F.max(F.size(F.split(path, "/")) - 1)).first()
    return row[0] or 0, row[1] or 0


def candidates(host: Column, path: Column, labels: int, parts: int) -> Column:
    """Keys of a URL: host suffixes of up to ``labels`` labels with path
    prefixes that end in one of the first ``parts`` slashes.  Deeper keys
    cannot be listed, so a long URL has no more keys than a short one."""
    names = F.split(host, r"\.")
    steps = F.split(path, "/")
    most = F.least(F.size(names), F.lit(labels))
    suffixes = F.transform(F.sequence(F.lit(1), most),
                           lambda i: F.array_join(F.slice(names, F.size(names) - i + 1, i), "."))
    deep = F.least(F.size(steps) - 1, F.lit(parts))
    prefixes = F.when(deep >= 1, F.transform(
        F.sequence(F.lit(1), F.greatest(deep, F.lit(1))),
        lambda i: F.concat(F.array_join(F.slice(steps, 1, i), "/"), F.lit("/")))).otherwise(
            F.array().cast("array<string>"))
    return F.when(F.lit(labels > 0 and parts > 0), F.flatten(F.transform(
        suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))).otherwise(
            F.array().cast("array<string>"))


def judge(pages: DataFrame, allow: DataFrame, block: DataFrame, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """One row per page: (id, host, path, rule, verdict).

    ``allow`` and ``block`` have a string column ``key``: a host, then a path
    that starts and ends with a slash.  A key fits its host and all subdomains
    if the URL's path starts with its path; of the fitting keys the longest
    decides (allow, if it is on both lists).  A URL that no list holds is
    allowed: its rule is null.  Null URLs and such without ``://`` have an
    empty host and path and fit nothing; repeated keys count once, null keys
    not at all; repeated rows keep a row each; other columns are not read.
    """
    url = F.col(f"`{url_col}`").cast("string")
    base = pages.select(F.col(f"`{id_col}`").alias("_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    lists = {"allow": allow, "block": block}
    lists = {name: cut(keys.select("key").where("key is not null").distinct(), name) for name, keys in lists.items()}
    for name, keys in lists.items():
        if not keys.where(~F.col("key").rlike(r"^[^/]*/(.*/)?$")).isEmpty():
            raise ValueError(f"{name}: a key's path must start and end with a slash")
    both = lists["allow"].unionByName(lists["block"])
    labels, parts = _depths(both)
    keyed = base.withColumn("keys", candidates(F.col("host"), F.col("path"), labels, parts))
    counts = {name: keys.count() for name, keys in lists.items()}
    if max(counts.values()) > MOST_LISTED:
        return _joined(keyed, lists, id_col)
    universe = cut(keyed.select(F.explode("keys").alias("key")).distinct(), "universe")
    cascades = {}
    for name, keys in lists.items():
        built = cascade(keys, universe)
        if built is None:
            return _joined(keyed, lists, id_col)
        cascades[name] = built

    def longest(name: str) -> Column:
        held = F.filter("keys", cascades[name].holds)
        return F.array_max(F.transform(held, lambda k: F.struct(F.length(k).alias("n"), k.alias("key"))))

    found = keyed.withColumn("a", longest("allow")).withColumn("b", longest("block"))
    a, b = F.coalesce(F.col("a.n"), F.lit(-1)), F.coalesce(F.col("b.n"), F.lit(-1))
    return found.select(
        F.col("_id").alias(id_col), "host", "path",
        F.when(a >= b, F.col("a.key")).otherwise(F.col("b.key")).alias("rule"),
        F.when(b > a, "block").otherwise("allow").alias("verdict"))


def _joined(keyed: DataFrame, lists: dict[str, DataFrame], id_col: str) -> DataFrame:
    """The same result for lists of any length: distinct (host, path) pairs meet
    the lists by their keys, and the best key of each pair is joined back."""
    marked = lists["allow"].withColumn("v", F.lit("allow")).unionByName(lists["block"].withColumn("v", F.lit("block")))
    best = (keyed.select("host", "path", F.explode("keys").alias("key")).distinct().join(marked, "key")
            .groupBy("host", "path").agg(F.max(F.struct(
                F.length("key").alias("n"), (F.col("v") == "allow").alias("first"), "key", "v")).alias("r")))
    return keyed.join(best, ["host", "path"], "left").select(
        F.col("_id").alias(id_col), "host", "path", F.col("r.key").alias("rule"),
        F.coalesce("r.v", F.lit("allow")).alias("verdict"))
