"""URL filters: host and path rules, then a blocked Bloom filter of listed canonical URLs in front of an exact hash join.

The filter is a table of 64-bit blocks; a key sets a few bits of one block, so a probe touches one row. Its number of
blocks follows the list up to a stated maximum, which bounds what is broadcast; a fuller filter lets more rows through to
the exact join and never changes a verdict.

Defined cases: a null url or one without "://" has empty host and path, fits no rule and is on no list (allowed); repeated
rows are judged each alone; a null or empty listed URL is ignored; an empty list blocks nothing; extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverloom.llm.util import ascii_lower

#: (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
BITS_PER_KEY, BITS_SET, MAX_BLOCKS = 16, 4, 1 << 17


def rest_of(url: Column) -> Column:
    """What follows the first "://", else null."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(rest_of(url), r"^([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(rest_of(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without www. or m. and default port, path without closing slashes or index page, parameters sorted without tracking ones; no scheme, no fragment. Null without "://"."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^(www|m)\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"/index\.html?$", ""), r"/+$", "")
    query = F.regexp_extract(rest_of(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]+|ref|gclid|fbclid)(=|$)")))
    return F.when(rest_of(url).isNotNull(), F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null. A rule fits its host and all subdomains if the path starts with the rule's."""
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        hit = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _block(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def _mask(key: Column) -> Column:
    """Four bits of a 64-bit block."""
    h = F.xxhash64(F.lit("bits"), key)
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63).cast("long")).cast("int"))
    out = bit(0)
    for k in range(1, BITS_SET):
        out = out.bitwiseOR(bit(k))
    return out


def bloom(keys: DataFrame, key: str, max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """(block, bits) of the non-null keys and the number of blocks, at most max_blocks."""
    n = keys.agg(F.count(key).alias("n")).first()["n"]
    blocks = max(1, min(max_blocks, -(-n * BITS_PER_KEY // 64)))
    k = F.col(key)
    return keys.where(k.isNotNull()).groupBy(_block(k, blocks).alias("block")).agg(F.bit_or(_mask(k)).alias("bits")), blocks


def maybe_in(rows: DataFrame, keys: DataFrame, key: str, own: str, name: str, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """rows with boolean `name`: whether the column key may be among keys' column own (false for null). The filter's rows, max_blocks at most, are broadcast."""
    table, blocks = bloom(keys, own, max_blocks)
    k = F.col(key)
    probed = rows.withColumn("_block", _block(k, blocks)).join(F.broadcast(table.select(F.col("block").alias("_block"), F.col("bits").alias("_bits"))), "_block", "left")
    return probed.withColumn(name, F.coalesce(F.col("_bits").bitwiseAND(_mask(k)) == _mask(k), F.lit(False)) & k.isNotNull()).drop("_block", "_bits")


def listed(pages: DataFrame, listing: DataFrame, key: str = "canon", max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """pages with boolean `listed`: whether the key is among the listing's keys. Only possible hits go to the exact join, so that no other row is shuffled."""
    keys = listing.select(F.col(key).alias("_key")).where(F.col("_key").isNotNull() & (F.col("_key") != "")).distinct()
    probed = maybe_in(pages, keys, key, "_key", "_maybe", max_blocks)
    exact = probed.where("_maybe").join(keys.withColumn("_in", F.lit(True)), F.col(key) == F.col("_key"), "left")
    return exact.withColumn("listed", F.coalesce("_in", F.lit(False))).drop("_key", "_in", "_maybe").unionByName(probed.where("not _maybe").withColumn("listed", F.lit(False)).drop("_maybe"))


def judge(pages: DataFrame, listing: DataFrame, rules=RULES, page_id: str = "page_id", url: str = "url", listing_url: str = "url") -> DataFrame:
    """page_id, host, path, canon, rule, listed, verdict for every row of pages; a rule's verdict holds, else listed URLs are blocked."""
    u = F.col(url).cast("string")
    rows = pages.select(F.col(page_id).alias("page_id"), host_of(u).alias("host"), path_of(u).alias("path"), canonical(u).alias("canon"))
    marked = listed(rows, listing.select(canonical(F.col(listing_url).cast("string")).alias("canon")))
    marked = marked.withColumn("_r", rule_of(F.col("host"), F.col("path"), rules))
    method = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return marked.select("page_id", "host", "path", "canon", F.col("_r.rule").alias("rule"), "listed", F.coalesce("_r.verdict", method).alias("verdict"))
