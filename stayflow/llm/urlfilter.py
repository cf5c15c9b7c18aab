"""URL filter: host and path rules, then a list of URLs behind a blocked Bloom filter.

A rule fits a host, all its subdomains and the paths that begin with the rule's; of all
that fit, the longest decides. Where none fits, the URL is blocked if its canonical form
is listed. The list is first asked by a Bloom filter of blocks of 512 bits: a URL's hash
names one block, and one bit in each of its eight words must be set. The filter is a
table with a row for each block, made by an aggregate. Only URLs it passes, the listed
ones and a few others, go on to a join with the list itself, which removes the others.

The filter is broadcast if its size, known from the number of blocks, is at most
``BROADCAST_BYTES``; else it is joined by block number.

Defined cases: a null URL or one without ``://`` has an empty host and path, no canonical
form and is never listed; repeated rows each get a row; an empty table gives no rows, an
empty list blocks nothing; null entries of the list are left out; only the named columns
are read.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

BITS_PER_KEY = 16
BLOCK_BITS, WORDS = 512, 8
BROADCAST_BYTES = 16 << 20
ROW_BYTES = 96  # of one block in memory
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the production filter.
RULES = (
    Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"), Rule("com", "/de/", "block"),
)


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and query of a URL; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + F.lit(3))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    return host, path, query


def canonical(url: Column) -> Column:
    """Host without ``www.`` and default port, path without last slashes, query without campaign marks; null without ``://``."""
    host, path, query = url_parts(url)
    name = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    kept = F.regexp_replace(F.regexp_replace(query, r"(^|&)utm_[^&]*", ""), r"^&", "")
    whole = F.concat(name, F.regexp_replace(path, r"/+$", ""), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))
    return F.when(F.instr(url, "://") > 0, whole)


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; of equally long ones that with the longer host."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host))):  # the last one that fits stays
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, F.lit(r.text)).otherwise(text)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def _place(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks))


def _bit(key: Column, word: int) -> Column:
    """Which of a word's 64 bits stands for the key: six bits of a second hash."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit("bits")), 6 * word).bitwiseAND(F.lit(63)).cast("int")


def bloom_filter(keys: DataFrame, key_col: str, n_keys: int) -> tuple[DataFrame, int]:
    """(block, w0 ... w7) of the distinct keys, and the number of blocks."""
    n_blocks = max(1, -(-n_keys * BITS_PER_KEY // BLOCK_BITS))
    key = F.col(key_col)
    set_bits = keys.select(_place(key, n_blocks).alias("block"), *(F.call_function("shiftleft", F.lit(1).cast("long"), _bit(key, i)).alias(f"w{i}") for i in range(WORDS)))
    return set_bits.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS))), n_blocks


def possible(df: DataFrame, key_col: str, filter_: DataFrame, n_blocks: int) -> DataFrame:
    """``df`` with a column ``__possible``: whether the filter passes the key."""
    words = filter_.select(F.col("block").alias("__block"), *(F.col(f"w{i}").alias(f"__w{i}") for i in range(WORDS)))
    if n_blocks * ROW_BYTES <= BROADCAST_BYTES:
        words = F.broadcast(words)
    key = F.col(key_col)
    joined = df.join(words, F.coalesce(_place(key, n_blocks), F.lit(-1)) == F.col("__block"), "left")
    passed = F.lit(True)
    for i in range(WORDS):
        passed = passed & (F.getbit(F.col(f"__w{i}"), _bit(key, i)) == 1)
    return joined.select(*df.columns, F.coalesce(passed, F.lit(False)).alias("__possible"))


def judge_urls(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url", list_col: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, host, path, rule, verdict, listed) of every page; ``listed`` is a table of URLs to block."""
    keys = listed.select(canonical(F.col(list_col)).alias("key")).filter("key IS NOT NULL").distinct()
    filter_, n_blocks = bloom_filter(keys, "key", keys.count())
    host, path, _ = url_parts(F.col(url_col))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    judged = pages.select(F.col(id_col), host.alias("host"), path.alias("path"), canonical(F.col(url_col)).alias("key"))
    asked = possible(judged.withColumns({"rule": rule, "said": verdict}), "key", filter_, n_blocks)
    hits = asked.filter("__possible").join(keys.withColumn("listed", F.lit(True)), "key", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    out = hits.unionByName(asked.filter("NOT __possible").withColumn("listed", F.lit(False)))
    said = F.coalesce("said", F.when(F.col("listed"), "block").otherwise("allow"))
    return out.select(id_col, "host", "path", "rule", said.alias("verdict"), "listed")
