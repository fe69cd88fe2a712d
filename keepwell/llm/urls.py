"""URL filter: prefix rules first, then a list of canonical URLs behind a blocked Bloom filter.

A URL has a host (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased) and a path (then up to ``?``,
``#`` or the end). A rule (verdict, host, path) fits its host and all subdomains if the URL's path starts with the
rule's; of several the longest text ``host + path`` wins, then the longer host.

The list may be as large as the pages. Its canonical URLs set bits in a blocked Bloom filter: a URL's hash
names one block of ``WORDS`` numbers of 64 bits and ``BITS`` bits in each. The filter has at most ``MOST_BLOCKS`` rows whatever the
list's size (a fuller filter lets more through, none wrongly), so it may be broadcast. Pages it turns away are done without
a shuffle; the possible hits go to an exact hash join with the list, which removes the false ones. Everything is
DataFrame functions.

Nulls and texts without ``://`` have an empty host and path, fit no rule and are never listed. A host
or path may be empty. Repeated pages are judged alike, ties of rules as above, repeated list entries count once; an
empty table or an empty list is no special case. Columns of the pages other than key and url are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from keepwell.session import written

#: numbers of 64 bits in a block, bits that a URL sets in each, bits of filter for each listed URL
WORDS = 4
BITS = 2
BITS_A_URL = 16
#: rows of the filter at most: 10 MB of numbers
MOST_BLOCKS = 1 << 18


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# fixed values: the rules of the query
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)

# fixed values: parts of host names that stand for a category no text is taken from
LISTED_PARTS = ("ads", "adult", "bets", "casino", "farm", "pills", "porn", "spam", "track", "xxx")

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def canonical(host: Column, path: Column) -> Column:
    """The host without one leading ``www.`` and the path without slashes at its end; null without a host."""
    bare = F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"/+$", ""))
    return F.when(host != "", bare)


def rule_for(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> tuple[Column, Column]:
    """(text, verdict) of the winning rule, null where none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host))):  # a later one covers the earlier
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _masks(url: Column) -> list[Column]:
    """One number for each word of the block: the bits that a URL sets."""
    out = []
    for word in range(WORDS):
        bits = F.xxhash64(url, F.lit(word + 1))
        mask = F.lit(0).cast("long")
        for i in range(BITS):
            place = F.shiftrightunsigned(bits, 6 * i).bitwiseAND(63).cast("int")
            mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
        out.append(mask)
    return out


def with_bits(rows: DataFrame, url: str, blocks: int) -> DataFrame:
    """``rows`` with the block and the bits of ``url``."""
    block = F.pmod(F.xxhash64(F.col(url)), F.lit(blocks).cast("long")).alias("_block")
    return rows.select("*", block, *[m.alias(f"_bits{i}") for i, m in enumerate(_masks(F.col(url)))])


def bloom_filter(listed: DataFrame, url: str, blocks: int) -> DataFrame:
    """_block, _word0..: at most ``blocks`` rows, each the union of its URLs' bits."""
    return with_bits(listed.select(url), url, blocks).groupBy("_block").agg(
        *[F.bit_or(f"_bits{i}").alias(f"_word{i}") for i in range(WORDS)]
    )


def filter_blocks(urls: int, most: int = MOST_BLOCKS) -> int:
    return max(1, min(most, -(-urls * BITS_A_URL // (64 * WORDS))))


def judge(
    pages: DataFrame,
    listed: DataFrame,
    key: str = "page_id",
    url: str = "url",
    rules: Sequence[Rule] = RULES,
    most_blocks: int = MOST_BLOCKS,
) -> DataFrame:
    """``key``, host, path, rule, verdict, canonical_url and possible (whether the filter let the page through) of every page.

    ``listed`` has one column, canonical URLs to block. A rule's verdict stands above the list's.
    """
    entries = written(listed.toDF("entry").filter("entry IS NOT NULL").distinct())
    blocks = filter_blocks(entries.count(), most_blocks)

    address = F.col("_url")
    split = pages.select(F.col(key).alias("_key"), F.col(url).alias("_url")).select(
        "_key", host_of(address).alias("host"), path_of(address).alias("path")
    )
    text, verdict = rule_for(F.col("host"), F.col("path"), rules)
    split = split.select(
        "*", text.alias("rule"), verdict.alias("_ruled"), canonical(F.col("host"), F.col("path")).alias("canonical_url")
    )
    probed = with_bits(split, "canonical_url", blocks)
    sieve = F.broadcast(bloom_filter(entries, "entry", blocks))  # most_blocks rows of WORDS + 1 numbers at most
    set_bits = [F.col(f"_word{i}").bitwiseAND(F.col(f"_bits{i}")) == F.col(f"_bits{i}") for i in range(WORDS)]
    through = F.col("canonical_url").isNotNull()
    for bit in set_bits:
        through = through & F.coalesce(bit, F.lit(False))
    sifted = probed.join(sieve, "_block", "left").select(*split.columns, through.alias("possible"))

    # the list is read by the pages that pass alone; the others never leave their task
    hits = sifted.filter("possible").join(entries, F.col("canonical_url") == F.col("entry"), "left")
    hits = hits.select(*sifted.columns, F.col("entry").isNotNull().alias("_listed"))
    rest = sifted.filter("NOT possible").withColumn("_listed", F.lit(False))
    return hits.unionByName(rest).select(
        F.col("_key").alias(key),
        "host",
        "path",
        "rule",
        F.coalesce("_ruled", F.when(F.col("_listed"), "block").otherwise("allow")).alias("verdict"),
        "canonical_url",
        "possible",
    )


def named_bad(pages: DataFrame, url: str = "url", parts: Sequence[str] = LISTED_PARTS) -> DataFrame:
    """entry: canonical URLs of the pages whose host name has one of ``parts`` between dots and hyphens."""
    hosts = pages.select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    bad = F.arrays_overlap(F.split("host", r"[.-]"), F.array(*[F.lit(p) for p in parts]))
    return hosts.filter(bad).select(canonical(F.col("host"), F.col("path")).alias("entry")).distinct()
