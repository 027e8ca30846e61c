"""Filter URLs by rules and by a list, with a blocked Bloom filter before an exact join.

Rules and listed URLs are keys of the form ``host/path``. Each page URL has a few keys
that could be listed: its host and parent domains with the path cut at the lengths that
rules have, and its canonical form. A blocked Bloom filter of the listed keys passes
those that may be listed; an exact hash join with the list then removes the false
positives. Only keys that passed reach the join, so its shuffle holds about the hits.

The filter is a table of blocks: eight 32-bit words each, one bit of every word set per
key, merged with ``bit_or``. It is broadcast while it has at most ``BROADCAST_BLOCKS``
blocks, 96 bytes each; a larger one is joined by block number.

Defined cases: a null url, or one without ``://``, has an empty host and path, matches no
rule and no listed URL, and is allowed. Repeated rows are judged alike and all returned; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streakline.functions.sizing import broadcast_if_small
from streakline.session import stage

#: Fixed values of the contract: verdict, host, path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Words of a host name for which the query lists a page's URL.
LISTED_WORDS = ["pills", "casino", "bets", "loans", "porn", "adult", "poker", "viagra"]
WORDS, KEYS_PER_BLOCK, BROADCAST_BLOCKS = 8, 16, 65_536
LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)^[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.`` or ``m.`` and path without ``.html`` and closing slash; null without a host."""
    bare = F.regexp_replace(host, r"^(www|m)\.", "")
    return F.when(host != "", F.concat(bare, F.regexp_replace(path, r"(\.html)?/*$", "")))


def _place(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """A key's block and its bit in each of the block's words."""
    bits = F.xxhash64(key, F.lit("bits"))
    one = F.lit(1).cast("bigint")
    return (
        F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block"),
        [F.call_function("shiftleft", one, F.pmod(F.shiftright(bits, 5 * i), F.lit(32)).cast("int")) for i in range(WORDS)],
    )


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter as a table: ``block`` and words ``w0`` to ``w7``; absent blocks are empty."""
    block, bits = _place(F.col("key"), blocks)
    placed = keys.select(block, *[b.alias(f"w{i}") for i, b in enumerate(bits)])
    return placed.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def possible_hits(candidates: DataFrame, filter_: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``candidates`` whose ``key`` may be in the list; never drops one that is."""
    block, bits = _place(F.col("key"), blocks)
    placed = candidates.where("key is not null").select(
        *[F.col(c) for c in candidates.columns], block, *[b.alias(f"b{i}") for i, b in enumerate(bits)]
    )
    hit = F.lit(True)
    for i in range(WORDS):
        hit = hit & (F.col(f"w{i}").bitwiseAND(F.col(f"b{i}")) != 0)
    sized = F.broadcast(filter_) if blocks <= BROADCAST_BLOCKS else filter_
    return placed.join(sized, "block").where(hit).select(*candidates.columns)


def listed_hits(candidates: DataFrame, listed: DataFrame) -> DataFrame:
    """``candidates`` (with ``key``) joined with ``listed`` (distinct ``key`` and more) by key.

    The list is staged; its size fixes the filter's: about ``KEYS_PER_BLOCK`` keys a block.
    """
    listed = stage(listed)
    blocks = max(1, -(-listed.count() // KEYS_PER_BLOCK))
    passed = possible_hits(candidates, bloom_blocks(listed.select("key"), blocks), blocks)
    return passed.join(listed, "key")


def judge_urls(
    pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = tuple(RULES)
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    A rule fits its host and all subdomains, if the path starts with the rule's; the longest
    rule wins. Where none fits, a URL whose canonical form is in ``listed`` (column ``key``)
    is blocked, any other allowed. ``rules`` is a parameter and small; the list may be large.
    """
    spark = pages.sparkSession
    host, path = host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    names = stage(pages.select(host, path).where("host != ''").distinct())
    rule_rows = spark.createDataFrame(
        [(f"{h}{p}", v, len(h) + len(p)) for v, h, p in rules], "key string, verdict string, width int"
    )
    lengths = sorted({len(p) for _, _, p in rules})
    # Every parent domain with the path at every length that a rule has.
    labels = F.split("host", r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    heads = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths])
    keys = F.flatten(F.transform(domains, lambda d: F.transform(heads, lambda h: F.concat(d, h))))
    candidates = names.select("host", "path", F.explode(F.array_distinct(keys)).alias("key"))
    ruled = (
        listed_hits(candidates, rule_rows)
        .groupBy("host", "path")
        .agg(F.max(F.struct("width", "key", "verdict")).alias("best"))
    )
    forms = names.select("host", "path", canonical(F.col("host"), F.col("path")).alias("key"))
    blocked = listed_hits(forms, listed.select("key").where("key is not null").distinct()).select(
        "host", "path", F.lit("block").alias("by_list")
    )
    judged = stage(ruled.join(blocked, ["host", "path"], "full"))
    out = pages.select("page_id", host, path).join(broadcast_if_small(judged), ["host", "path"], "left")
    return out.select(
        "page_id",
        "host",
        "path",
        F.col("best.key").alias("rule"),
        F.coalesce("best.verdict", "by_list", F.lit("allow")).alias("verdict"),
    )


def urls_by_words(pages: DataFrame, words: Sequence[str] = tuple(LISTED_WORDS)) -> DataFrame:
    """Canonical URLs of pages whose host name has one of ``words``: the list of the query."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    found = pages.select(canonical(host, path).alias("key"), host.alias("host")).where(
        F.col("host").rlike("|".join(words))
    )
    return found.where("key is not null").select("key").distinct()


SQL = r"""
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), named AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), formed AS (
    SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(\.html)?/*$', '') END AS form
    FROM named
), listed AS (
    SELECT DISTINCT form FROM formed WHERE regexp_matches(host, 'pills|casino|bets|loans|porn|adult|poker|viagra')
), rules(verdict, host, path) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
           ('block', 'net', '/es/'), ('block', 'net', '/fr/')
)
SELECT page_id, host, path,
       (SELECT arg_max(r.host || r.path, length(r.host || r.path)) FROM rules r
        WHERE (f.host = r.host OR suffix(f.host, '.' || r.host)) AND prefix(f.path, r.path)) AS rule,
       coalesce((SELECT arg_max(r.verdict, length(r.host || r.path)) FROM rules r
        WHERE (f.host = r.host OR suffix(f.host, '.' || r.host)) AND prefix(f.path, r.path)),
        CASE WHEN f.form IN (SELECT form FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM formed f
"""
