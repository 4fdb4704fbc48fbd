"""URL filter: rules by host and path, then a list of URLs through a blocked Bloom filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import ascii_lower, saved

#: 64-bit words of a block; every listed URL sets one bit in each, so a probe reads one block.
WORDS = 4
#: Keys a block is meant for: 4 of 64 bits per key word, about one false hit in 300.
KEYS_PER_BLOCK = 16
#: The filter is broadcast, so it has at most this many blocks (2 MB of bits). A longer list makes
#: a denser filter and more false hits, which the exact join removes.
MAX_BLOCKS = 1 << 16

Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or
    without ``://``: empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; null or without ``://``: empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` or ``m.`` and path without ``.html`` or a last slash."""
    bare = F.regexp_replace(host, r"^(www|m)\.", "")
    return F.concat(bare, F.regexp_replace(path, r"(\.html|/)$", ""))


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else nulls. A rule (verdict, host, path)
    fits its host and all subdomains of it where the URL's path starts with the rule's."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def _masks(key: Column) -> tuple[Column, list[Column]]:
    """The block number's hash and, for each word of a block, the bit that the key sets there."""
    spread, bits = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    masks = [
        F.call_function(
            "shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(bits, 6 * i).bitwiseAND(63).cast("int")
        )
        for i in range(WORDS)
    ]
    return spread, masks


def bloom_blocks(keys: DataFrame, key: str, max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """The filter as a table: a block number and its words, at most ``max_blocks`` rows. Bits are
    merged in the map tasks, so a shuffle moves at most the filter from each of them."""
    blocks = max(1, min(max_blocks, -(-keys.count() // KEYS_PER_BLOCK)))
    spread, masks = _masks(F.col(key))
    table = (
        keys.select(
            F.pmod(spread, F.lit(blocks)).cast("int").alias("__block"),
            *[m.alias(f"__w{i}") for i, m in enumerate(masks)],
        )
        .groupBy("__block")
        .agg(*[F.bit_or(f"__w{i}").alias(f"__w{i}") for i in range(WORDS)])
    )
    return table, blocks


def judge_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[Rule] = (),
    id_col: str = "page_id",
    url_col: str = "url",
    listed_url_col: str = "url",
    max_blocks: int = MAX_BLOCKS,
) -> DataFrame:
    """One row per page: page_id, host, path, rule (null: none fits), verdict.

    The longest fitting rule decides. Where none fits, the page is blocked if its canonical URL is
    the canonical URL of a row of ``listed``, else allowed. The filter sends nearly only listed
    URLs on; the exact join on the URL itself decides, and both sides of it are plain shuffles
    that Spark can split where one URL has many pages.

    Null and odd URLs have empty host and path, are never listed and are allowed; repeated rows of
    pages give repeated rows; repeated, null and odd rows of ``listed`` change nothing; an empty
    list allows all pages without a rule. Other columns of either table are not read."""
    url = F.col(f"`{url_col}`").cast("string")
    parts = pages.select(F.col(f"`{id_col}`").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    text, verdict = best_rule(F.col("host"), F.col("path"), rules)
    parts = parts.withColumns({"rule": text, "__verdict": verdict, "__key": canonical(F.col("host"), F.col("path"))})
    other = F.col(f"`{listed_url_col}`").cast("string")
    keys = saved(
        listed.select(canonical(host_of(other), path_of(other)).alias("__listed"))
        .filter(F.col("__listed") != "")
        .distinct(),
        "listed-urls",
    )
    table, blocks = bloom_blocks(keys, "__listed", max_blocks)
    table = saved(table.coalesce(1), "url-filter")
    spread, masks = _masks(F.col("__key"))
    open_pages = parts.filter(F.col("rule").isNull()).withColumn(
        "__block", F.pmod(spread, F.lit(blocks)).cast("int")
    )
    # At most max_blocks rows of five numbers: a proven bound.
    probed = open_pages.join(F.broadcast(table), "__block", "left")
    hit = F.lit(True)
    for i, mask in enumerate(masks):
        hit = hit & (F.col(f"__w{i}").bitwiseAND(mask) != 0)
    hit = F.coalesce(hit, F.lit(False))
    columns = ["page_id", "host", "path", "rule"]
    ruled = parts.filter(F.col("rule").isNotNull()).select(*columns, F.col("__verdict").alias("verdict"))
    passed = probed.filter(~hit).select(*columns, F.lit("allow").alias("verdict"))
    possible = probed.filter(hit).select(*columns, "__key")
    exact = possible.join(keys, F.col("__key") == F.col("__listed"), "left").select(
        *columns, F.when(F.col("__listed").isNull(), "allow").otherwise("block").alias("verdict")
    )
    return ruled.unionByName(passed).unionByName(exact)
