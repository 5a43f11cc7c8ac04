"""URL filters: a blocked Bloom filter in front of an exact hash join.

Listed canonical URLs and rules (host, path, verdict) share one key space. A blocked Bloom
filter of all listed keys, itself a DataFrame of (block, eight words), is probed by every
key a URL could match; what passes is joined exactly with the list, which removes the false
positives. Everything is native: no Python runs on the executors.

Rules: a rule fits its host and all subdomains, if the URL's path starts with the rule's
path. The longest fitting rule decides; at equal length the smaller text. Without a rule, a
URL whose canonical form is listed is blocked and any other is allowed.

Edge cases: a null URL, or one without "://", has an empty host and path and no rule and is
allowed, as are all URLs against an empty list without rules. Repeated list entries, rules
and pages change nothing. Rules with a null host or path are ignored. Very long URLs
are compared whole. Other columns of the
pages are kept unless their names clash with those returned, which replace them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of the filter for each key, and words of 32 bits in a block; a key sets one in each.
BITS_PER_KEY, WORDS = 16, 8
#: The filter is broadcast up to this size and joined by block beyond it.
BROADCAST_BYTES = 64 << 20


def _rest(url: Column) -> Column:
    found = F.instr(url, "://")
    return F.when(found > 0, F.substr(url, found + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What stands between "://" and the next / ? # or the end, with A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ? # or the end."""
    return F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host and path without a leading "www." and trailing slashes; null without a host."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    joined = F.concat(host, F.regexp_replace(path_of(url), "/+$", ""))
    return F.when(host != "", joined)


def _spots(key: Column, blocks: int) -> tuple[Column, Column]:
    """A key's block, and a second hash whose digits of 5 bits name a bit of each word."""
    return F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block"), F.xxhash64(key, F.lit(17))


def _bit(digits: Column, word: int) -> Column:
    place = F.shiftrightunsigned(digits, 5 * word).bitwiseAND(F.lit(31)).cast("int")
    # shiftleft takes a constant only, so the bit is looked up
    return F.element_at(F.array(*[F.lit(1 << i).cast("long") for i in range(32)]), place + 1)


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """Rows (block, w0 .. w7) of the filter over column key; empty blocks are absent."""
    block, digits = _spots(F.col("key"), blocks)
    spread = keys.select(block, digits.alias("digits"))
    return spread.groupBy("block").agg(
        *[F.bit_or(_bit(F.col("digits"), i)).alias(f"w{i}") for i in range(WORDS)]
    )


def probe(candidates: DataFrame, filter_rows: DataFrame, blocks: int, small: bool) -> DataFrame:
    """The candidates that the filter does not rule out."""
    block, digits = _spots(F.col("key"), blocks)
    spread = candidates.withColumn("block", block).withColumn("digits", digits)
    hit = F.lit(True)
    for i in range(WORDS):
        hit = hit & (F.col(f"w{i}").bitwiseAND(_bit(F.col("digits"), i)) != 0)
    side = F.broadcast(filter_rows) if small else filter_rows
    return spread.join(side, "block").where(hit).select(*candidates.columns)


def _candidates(urls: DataFrame, lengths: list[int]) -> DataFrame:
    """Every key that could match a URL: its canonical form, and for rules each host suffix
    with each path prefix of a length that rules have."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parts = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."),
    )
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(x) for x in lengths]).cast("array<int>"), lambda n: n <= F.length(path)),
        lambda n: F.substr(path, F.lit(1), n),
    )
    rules = F.flatten(
        F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(F.lit("r "), s, p)))
    )
    exact = F.array_compact(F.array(F.concat(F.lit("u "), canonical(F.col("url")))))
    keys = F.concat(exact, F.when(host != "", rules).otherwise(F.array().cast("array<string>")))
    return urls.select("url", F.explode(F.array_distinct(keys)).alias("key"))


def filter_urls(pages: DataFrame, listed: DataFrame, rules: DataFrame) -> DataFrame:
    """The pages with host, path, rule and verdict.

    pages: url and anything else; listed: url, the blocked ones; rules: host, path, verdict
    (allow or block). Counting the keys, which sizes the filter, and the path lengths of the
    rules are small jobs of their own.
    """
    entries = (
        rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
        .select(
            F.concat(F.lit("r "), "host", "path").alias("key"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        )
        .union(
            listed.select(
                F.concat(F.lit("u "), canonical(F.col("url"))),
                F.lit(None).cast("string"),
                F.lit("block"),
            ).where(F.col("url").isNotNull())
        )
        .toDF("key", "rule", "verdict")
        .where("key IS NOT NULL")
        .groupBy("key", "rule")
        .agg(F.min("verdict").alias("verdict"))
    )
    size = entries.count()
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect() if r[0] is not None)
    blocks = max(1, -(-size * BITS_PER_KEY // (32 * WORDS)))
    small = blocks * (WORDS + 1) * 8 <= BROADCAST_BYTES

    urls = pages.select("url").where("url IS NOT NULL").distinct()
    passed = probe(_candidates(urls, lengths), bloom(entries, blocks), blocks, small)
    hits = passed.join(entries, "key")
    # rules come before the list; among rules the longest, then the smaller text
    best = hits.groupBy("url").agg(
        F.min(
            F.struct(
                F.col("rule").isNull().alias("listed"),
                (-F.length(F.coalesce("rule", F.lit("")))).alias("shortness"),
                "rule",
                "verdict",
            )
        ).alias("hit")
    )
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    return pages.select(*[pages[c] for c in kept]).join(best, "url", "left").select(
        *[F.col(c) for c in kept],
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", F.lit("allow")).alias("verdict"),
    )
