"""URL rules: a blocked Bloom filter of the listed canonical URLs, then an exact hash join.

A rule is a listed canonical URL (host and path) with a verdict. It fits a URL whose host is
the rule's or a subdomain of it and whose path starts with the rule's; the longest wins. So
the listed URLs that can fit a URL are few and known: its host's suffixes times the starts of
its path that are as long as some rule's path. Those candidates are looked up, never the
rules scanned.

Only built-in expressions. Nulls, a missing `://` and an empty URL give an empty host and
path, which no rule fits. Repeated rows are judged one by one; a rule listed twice with both
verdicts blocks. Empty tables give an empty result, an empty list allows everything. Other
columns of the pages are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.llm.bloom import filter_bits, filter_block

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Bits of the filter for each listed URL, and its greatest size in 64-bit blocks (1 MiB).
#: A longer list only makes the filter pass more; the exact join decides all the same.
BITS_PER_URL = 16
MOST_BLOCKS = 1 << 17


def url_host(url: Column) -> Column:
    """What stands after the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case."""
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.translate(host, UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def bloom_filter(keys: DataFrame, column: str) -> np.ndarray:
    """The filter of a column's strings as 64-bit blocks. Spark sets the bits; what comes to
    the driver is the filter itself, whose size is bounded by MOST_BLOCKS."""
    count = keys.agg(F.approx_count_distinct(column)).first()[0]
    blocks = 1
    while blocks < MOST_BLOCKS and blocks * 64 < count * BITS_PER_URL:
        blocks *= 2
    key = F.col(column)
    rows = (
        keys.groupBy(filter_block(key, blocks).alias("block"))
        .agg(F.bit_or(filter_bits(key)).alias("bits"))
        .collect()
    )
    words = np.zeros(blocks, dtype=np.int64)
    for row in rows:
        words[row["block"]] = row["bits"]
    return words


def may_contain(words: np.ndarray, key: Column) -> Column:
    mask = filter_bits(key)
    held = F.get(F.lit(words), filter_block(key, len(words)))
    return held.bitwiseAND(mask) == mask


def judge_urls(pages: DataFrame, rules: DataFrame, page_id: str = "page_id") -> DataFrame:
    """page_id, host, path, rule, verdict for every row of pages (page_id, url).

    rules: host, path, verdict (`allow` or `block`). A URL that no rule fits is allowed and
    its rule is null. Lengths are compared over host and path together; they are the same
    thing for rules that fit one URL with one host, and prefer the longer host else.
    """
    listed = rules.select(
        F.concat("host", "path").alias("rule"),
        F.struct("host", "path").alias("parts"),
        "verdict",
    ).groupBy("rule", "parts").agg(F.max("verdict").alias("verdict"))
    # How rules look: how many labels their hosts have and how long their paths are. At most
    # as many values as a URL has characters, however long the list.
    shape = rules.agg(
        F.collect_set(F.size(F.split("host", r"\."))).alias("labels"),
        F.collect_set(F.length("path")).alias("lengths"),
    ).first()
    words = bloom_filter(listed, "rule")

    url = F.col("url")
    read = pages.select(
        F.col(page_id).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path")
    )
    labels = F.split("host", r"\.")
    # Of every length that rules have: the host's last labels, the path's first characters.
    hosts = F.array(
        *[
            F.when(F.size(labels) >= n, F.concat_ws(".", F.slice(labels, -n, n)))
            for n in sorted(shape["labels"])
        ]
    ).cast("array<string>")
    starts = F.array(
        *[
            F.when(F.length("path") >= n, F.substring("path", 1, n))
            for n in sorted(shape["lengths"])
        ]
    ).cast("array<string>")
    candidates = F.flatten(
        F.transform(hosts, lambda h: F.transform(starts, lambda p: F.struct(
            h.alias("host"), p.alias("path"))))
    )
    possible = F.filter(
        candidates,
        lambda c: c["host"].isNotNull()
        & c["path"].isNotNull()
        & may_contain(words, F.concat(c["host"], c["path"])),
    )
    probed = read.withColumn("possible", possible)

    # The exact join, for each different host and path that the filter let through. Most
    # repeats of a host and path are dropped where they are read.
    hits = probed.where(F.size("possible") > 0).select("host", "path", "possible").distinct()
    fitting = (
        hits.select("host", "path", F.explode("possible").alias("parts"))
        .join(listed.hint("shuffle_hash"), "parts")
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    F.length("rule").alias("length"), F.length(F.col("parts.host")), "rule",
                    "verdict",
                )
            ).alias("best")
        )
        .select("host", "path", "best.rule", "best.verdict")
    )
    passed = probed.where(F.size("possible") > 0).drop("possible")
    judged = passed.join(fitting, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict")
    )
    free = probed.where(F.size("possible") <= 0).select(
        "page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
        F.lit("allow").alias("verdict"),
    )
    return judged.unionAll(free)
