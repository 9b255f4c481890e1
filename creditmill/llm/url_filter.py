"""URL rules by host suffix and path prefix, joined on short hashes.

Each URL is expanded to every pair of a host suffix and a path prefix that a rule could
have. The pairs meet the rules by equality of four-byte hash prefixes; a match counts
only when the full SHA-256 digest agrees, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmill.llm.tables import pick

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULE_SCHEMA = "verdict string, host string, path string"
# Hexadecimal digits of the digest that the join compares.
SHORT = 8
# Rules sent to every task at most; more are shuffled.
BROADCAST_RULES = 200_000


def url_host(url: Column) -> Column:
    """What stands between the first :// and the next / ? # or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ? # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every row of `pages`.

    `rules` has (verdict, host, path); a path includes its leading slash. A rule fits its
    host and all subdomains, if the path starts with the rule's. Of the rules that fit,
    the longest (host and path together) wins, at equal length the longer host, then
    block before allow. A URL that no rule fits, without ://, or null gets `default` and a
    null rule. Rows are judged one by one, so repeated page_ids are kept as they are; an
    empty table gives an empty result.
    """
    rules = pick(rules, "verdict", "host", "path").where("host is not null and path is not null")
    # Lengths that rule paths have: at most as many as a path has characters.
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect()]
    keyed = rules.select(
        digest(F.col("host"), F.col("path")).alias("_full"),
        F.struct(
            (F.length("host") + F.length("path")).alias("size"), F.length("host").alias("hosts"),
            (F.col("verdict") == "block").alias("blocks"), "verdict", F.concat("host", "path").alias("rule"),
        ).alias("_found"),
    )
    keyed = keyed.groupBy(F.substring("_full", 1, SHORT).alias("_key"), "_full").agg(F.max("_found").alias("_found"))
    if rules.count() <= BROADCAST_RULES:
        keyed = F.broadcast(keyed)

    split = pick(pages, "page_id", "url").select(
        F.monotonically_increasing_id().alias("_row"), "page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")
    )
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."),
    )
    prefixes = F.filter(
        F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]).cast("array<string>"),
        lambda p: p.isNotNull(),
    )
    pairs = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: digest(h, p))))
    expanded = split.select("*", F.explode_outer(F.array_distinct(pairs)).alias("_digest"))
    met = expanded.join(keyed, F.substring("_digest", 1, SHORT) == keyed["_key"], "left")
    confirmed = F.when(F.col("_digest") == F.col("_full"), F.col("_found"))
    best = met.groupBy("_row", "page_id", "host", "path").agg(F.max(confirmed).alias("_found"))
    return best.select(
        "page_id", "host", "path", F.col("_found.rule").alias("rule"),
        F.coalesce(F.col("_found.verdict"), F.lit(default)).alias("verdict"),
    )
