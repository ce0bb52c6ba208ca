"""URL filter: a blocked Bloom filter lets possible hits through to an exact hash join with the list.

A block of the filter is 512 bits in eight long columns; a key sets one bit in each. The filter is built by a bitwise-or
aggregate, combined before the shuffle, and is a table of one row per block. It is broadcast while its exact size is within
``BROADCAST_BYTES``; a longer list is probed by a shuffle join on the block, whose hot blocks (a URL that many rows repeat)
are spread by a salt. Only rows whose eight bits are all set reach the join by canonical URL, which removes false positives.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.sources.scratch import written

#: Bits of the filter per listed URL.
BITS_PER_URL = 16
WORDS = 8
#: Largest filter that is broadcast.
BROADCAST_BYTES = 32 << 20
#: Rows of one block or URL are dealt to so many tasks.
SALTS = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains and for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def with_parts(df: DataFrame, url_col: str) -> DataFrame:
    """Adds ``host`` (A-Z lower-cased), ``path`` and ``canonical``; all are empty, the last null, without ``://``."""
    at = F.instr(F.col(url_col), "://")
    split = df.withColumn("_rest", F.when(at > 0, F.substr(F.col(url_col), at + 3)))
    host = F.translate(F.regexp_extract("_rest", "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract("_rest", "^[^/?#]*([^?#]*)", 1)
    query = F.regexp_replace(F.regexp_extract("_rest", r"^[^?#]*\?([^#]*)", 1), "(^|&)(utm_[^=&]*|ref)=[^&]*", "")
    canonical = F.concat(
        F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, r"(/|\.html)+$", ""), F.lit("?"), F.regexp_replace(query, "^&", ""),
    )
    return (
        split.withColumn("host", F.coalesce(host, F.lit(""))).withColumn("path", F.coalesce(path, F.lit("")))
        .withColumn("canonical", canonical).drop("_rest")
    )


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null where none does. Of equally long ones the first given wins."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules[::-1], key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bit(key: Column, word: int) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(F.xxhash64(key, F.lit("bits")), 6 * word).bitwiseAND(63).cast("int"))


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """``block, w0 .. w7`` of the filter over column ``canonical``."""
    key = F.col("canonical")
    return listed.groupBy(_block(key, blocks).alias("block")).agg(*(F.bit_or(_bit(key, i)).alias(f"w{i}") for i in range(WORDS)))


def _spread(large: DataFrame, small: DataFrame, row: Column) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt: rows of the large one get one of them, those of the small one all."""
    salts = F.array(*(F.lit(i) for i in range(SALTS)))
    return large.withColumn("_salt", F.pmod(F.xxhash64(row), F.lit(SALTS)).cast("int")), small.withColumn("_salt", F.explode(salts))


def judge(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[Rule] = RULES, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``id_col, host, path, rule, verdict, canonical, listed`` of every row.

    The longest fitting rule decides; without one, a URL on the list is blocked and any other allowed. A null URL, or one
    without ``://``, has an empty host and path and is allowed. An empty list blocks nothing. Repeated rows are judged each;
    null ids stay; other columns, whatever their names, are dropped. Null entries of the list are ignored.
    """
    rows = with_parts(pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_given")), "_given").drop("_given")
    entries = written(listed.select("canonical").where(F.col("canonical").isNotNull()).distinct(), "url-list")
    blocks = max(1, -(-entries.count() * BITS_PER_URL // (64 * WORDS)))
    bloom = bloom_blocks(entries, blocks)
    key = F.col("canonical")
    probed = rows.withColumn("block", _block(F.coalesce(key, F.lit("")), blocks))
    if blocks * 8 * (WORDS + 1) <= broadcast_bytes:
        probed = probed.join(F.broadcast(bloom), "block", "left")
    else:
        probed, bloom = _spread(probed, bloom, F.struct("_id", "canonical"))
        probed = probed.join(bloom, ["block", "_salt"], "left")
    every = F.lit(True)
    for i in range(WORDS):
        every = every & (F.col(f"w{i}").bitwiseAND(_bit(key, i)) != 0)
    probed = probed.withColumn("possible", F.coalesce(every, F.lit(False)))
    kept = ["_id", "host", "path", "canonical"]
    hits, entries = _spread(probed.where("possible").select(kept), entries.withColumn("listed", F.lit(True)), F.struct("_id", "host", "path"))
    exact = hits.join(entries, ["canonical", "_salt"], "left").select(*kept, F.coalesce("listed", F.lit(False)).alias("listed"))
    judged = probed.where("not possible").select(*kept, F.lit(False).alias("listed")).unionByName(exact)
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return judged.select(F.col("_id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "canonical", "listed")


#: Host labels whose pages make up the list of the registered query.
DENIED_LABELS = ("spam-farm", "cheap-pills", "casino-win", "adult-x")


def denied_urls(pages: DataFrame, url_col: str = "url", labels: Sequence[str] = DENIED_LABELS) -> DataFrame:
    """Canonical URLs of the pages under hosts with a denied label."""
    pattern = r"(^|[.])(" + "|".join(labels) + r")([.]|$)"
    return with_parts(pages.select(F.col(url_col).alias("_given")), "_given").where(F.col("host").rlike(pattern)).select("canonical")
