"""URL filters: rules first, then a block list held in a Bloom filter cascade.

The cascade answers exactly for every key of the corpus: level 0 encodes the
listed keys, level 1 the unlisted keys that level 0 takes for listed, level 2
the listed keys that level 1 takes for those, and so on until nobody is
mistaken. Asking the levels in turn until one says no gives the answer, with no
join of pages and lists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexvane.storage import written

# The rules, as (host and path, verdict).
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
# A label of two or more words joined by single hyphens; encoded names (``xn--``) have two.
HYPHENATED = r"(^|\.)[a-z0-9]+(-[a-z0-9]+)+(\.|\z)"

SHARD_KEYS = 50_000  # keys of the universe per shard, a bound on what one task builds
SEND_BYTES = 64 << 20  # cascades sent to the workers at once
BITS, PROBES = 10, 7  # of a level, for each key it encodes


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty if there is none."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``? #``; empty if there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, said in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def listed_host(host: Column) -> Column:
    """Whether a host has a hyphenated label, a common mark of advertising hosts."""
    return host.rlike(HYPHENATED)


def _key_hash(key: Column) -> Column:
    return F.xxhash64(key, F.lit(7))


def _positions(h: np.ndarray, level: int, m: int) -> np.ndarray:
    """Bit positions (rows: probes) by double hashing, a different pair for each level."""
    with np.errstate(over="ignore"):
        x = h.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level + 1) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(32)
    a, b = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
    return np.stack([(a + np.uint64(i) * b) % np.uint64(m) for i in range(PROBES)]).astype(np.int64)


def _says_yes(bits: np.ndarray, h: np.ndarray, level: int) -> np.ndarray:
    if not len(h):
        return np.zeros(0, bool)
    at = _positions(h, level, len(bits) * 8)
    return ((bits[at >> 3] >> (at & 7)) & 1).all(axis=0)


def build_levels(listed: np.ndarray, others: np.ndarray) -> list[np.ndarray]:
    """The bit arrays of a cascade exact for these key hashes (disjoint sets)."""
    levels: list[np.ndarray] = []
    inside, outside = np.unique(listed), np.unique(others)
    while len(inside):
        bits = np.zeros((len(inside) * BITS + 63) // 64 * 8, np.uint8)
        at = _positions(inside, len(levels), len(bits) * 8).ravel()
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        mistaken = outside[_says_yes(bits, outside, len(levels))]
        levels.append(bits)
        inside, outside = mistaken, inside
    return levels


def ask_levels(levels: list[np.ndarray], h: np.ndarray) -> np.ndarray:
    """Membership: the first level that says no decides, by whether it is odd."""
    answer = np.full(len(h), len(levels) % 2 == 1)
    open_ = np.arange(len(h))
    for level, bits in enumerate(levels):
        no = ~_says_yes(bits, h[open_], level)
        answer[open_[no]] = level % 2 == 1
        open_ = open_[~no]
    return answer


def build_cascade(keys: DataFrame) -> DataFrame:
    """``(key, listed)`` to ``(shard, level, bits)``, built by shards of bounded size.

    ``keys`` is the whole universe of keys; repeated ones count once, and a key
    given as listed anywhere is listed.
    """
    distinct = keys.groupBy(_key_hash(F.col("key")).alias("h")).agg(F.max("listed").alias("listed"))
    distinct = written(distinct, "cascade-keys")
    shards = max(1, -(-distinct.count() // SHARD_KEYS))

    def shard(rows: pd.DataFrame) -> pd.DataFrame:
        h, listed = rows["h"].to_numpy(), rows["listed"].to_numpy().astype(bool)
        levels = build_levels(h[listed], h[~listed])
        out = pd.DataFrame({"level": range(len(levels)), "bits": [b.tobytes() for b in levels]})
        return out.assign(shard=rows["shard"].iat[0], shards=shards)[["shard", "shards", "level", "bits"]]

    sharded = distinct.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
    built = sharded.groupBy("shard").applyInPandas(shard, "shard int, shards int, level int, bits binary")
    return written(built, "cascade")


def blocks_of(cascade: DataFrame, limit: int = SEND_BYTES) -> list[tuple[int, int]]:
    """Ranges of shards whose cascades are at most ``limit`` bytes (or one shard)."""
    sizes = cascade.groupBy("shard").agg(F.sum(F.length("bits")).alias("n")).orderBy("shard")
    blocks: list[list[int]] = []
    room = 0
    for row in sizes.toLocalIterator():
        if not blocks or row["n"] > room:
            blocks.append([row["shard"], row["shard"] + 1])
            room = limit
        blocks[-1][1] = row["shard"] + 1
        room -= row["n"]
    return [(a, b) for a, b in blocks]


def in_cascade(rows: DataFrame, cascade: DataFrame, limit: int = SEND_BYTES) -> DataFrame:
    """``rows`` (with ``key_hash``) and a column ``listed``.

    Cascades are sent in blocks of bounded size, each judging the rows of its
    own shards: usually one block, beyond ``limit`` one more pass for each.
    """
    head = cascade.select("shards").first()
    if head is None:  # nothing is listed
        return rows.withColumn("listed", F.lit(False))
    shards = head["shards"]
    whole = rows.withColumn("_shard", F.pmod("key_hash", F.lit(shards)).cast("int"))
    out, low = None, 0
    ranges = blocks_of(cascade, limit)
    for number, (_, high) in enumerate(ranges):
        high = shards if number == len(ranges) - 1 else high
        sent: dict[int, list[np.ndarray]] = {}
        block = cascade.filter((F.col("shard") >= low) & (F.col("shard") < high))
        for row in block.orderBy("shard", "level").toLocalIterator():
            sent.setdefault(row["shard"], []).append(np.frombuffer(row["bits"], np.uint8))
        handle = rows.sparkSession.sparkContext.broadcast(sent)

        @F.pandas_udf("boolean")
        def ask(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for shard, h in parts:
                answer = np.zeros(len(h), bool)
                shard, h = shard.to_numpy(), h.to_numpy()
                for s in np.unique(shard):
                    here = shard == s
                    answer[here] = ask_levels(handle.value.get(int(s), []), h[here])
                yield pd.Series(answer)

        mine = whole if len(ranges) == 1 else whole.filter((F.col("_shard") >= low) & (F.col("_shard") < high))
        judged = mine.withColumn("listed", ask("_shard", "key_hash"))
        out = judged if out is None else out.unionByName(judged)
        low = high
    return out.drop("_shard")


def judge_urls(pages: DataFrame, listed: DataFrame, rules=RULES, limit: int = SEND_BYTES) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` of every url.

    ``listed`` names blocked hosts in a column ``host``; names that no page has
    do no harm. A fitting rule decides, else the list: block if the host is
    listed. Null urls and urls without ``://`` have an empty host and path.
    Repeated rows stay, further columns are left out, and empty tables give
    empty tables (an empty list blocks nothing).
    """
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    no, yes = F.lit(False), F.lit(True)
    keys = split.select(F.col("host").alias("key"), no.alias("listed"), yes.alias("seen")).distinct()
    names = listed.select(F.coalesce("host", F.lit("")).alias("key"), yes.alias("listed"), no.alias("seen"))
    # The universe are the hosts of the pages; what lists and pages say of a key meets in one group.
    universe = keys.unionByName(names).groupBy("key").agg(F.max("listed").alias("listed"), F.max("seen").alias("seen"))
    marked = universe.filter("seen").select("key", "listed")
    cascade = build_cascade(marked)
    judged = in_cascade(split.withColumn("key_hash", _key_hash(F.col("host"))), cascade, limit)
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    return judged.select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
        "listed",
    )


def listed_hosts(pages: DataFrame) -> DataFrame:
    """A block list made from the pages where no other is given: their hosts with a hyphenated label."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).distinct()
    return hosts.filter(listed_host(F.col("host")))
