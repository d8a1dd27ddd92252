"""URL filters: host and path rules, then a listed-URL block list.

The list is screened by a blocked Bloom filter: every listed URL sets
``BITS`` bits in one 64-bit block of a filter sized by the list, pages whose block has
all their bits are possible hits, and an exact hash join with the list removes the false ones.
Everything is DataFrame functions.

Defined results: a null url, or one without ``://``, has an empty host and
path, no rule and is never listed, so it is allowed.  Repeated pages are judged
each for itself; extra columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import written

#: (verdict, rule) of the production query; the longest fitting rule wins.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

#: Bits that a listed URL sets, and bits of the filter for each.
BITS, BITS_PER_KEY = 5, 16
#: Blocks (rows of two longs) of a filter that is broadcast, some 16 MB, which is
#: enough for 4 million URLs.  A larger filter is joined block by block.
BROADCAST_BLOCKS = 1 << 20


def host(url: Column) -> Column:
    """A-Z lower-cased text between the first ``://`` and ``/``, ``?``, ``#`` or the end."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.`` and path without closing slashes; null where there is no host."""
    return F.when(host != "", F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, "/+$", "")))


def rule_columns(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest fitting rule; nulls where none fits."""
    rule, verdict = F, F
    for how, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        h, slash, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        rule, verdict = rule.when(fits, F.lit(text)), verdict.when(fits, F.lit(how))
    none = F.lit(None).cast("string")
    return (none, none) if rule is F else (rule.otherwise(none), verdict.otherwise(none))


def blocks_for(keys: int) -> int:
    """Blocks of 64 bits that give each of so many keys BITS_PER_KEY bits."""
    return max(1 << 10, 1 << (max(1, -(-keys * BITS_PER_KEY // 64)) - 1).bit_length())


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(blocks))


def _mask(key: Column) -> Column:
    """BITS bits of a 64-bit word, six bits of one hash for each."""
    h = F.xxhash64(key, F.lit(2))
    mask = F.lit(0).cast("long")
    for i in range(BITS):
        bit = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return mask


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """Blocked filter of column ``key``: at most ``blocks`` rows (block, word)."""
    return listed.groupBy(_block(F.col("key"), blocks).alias("block")).agg(F.bit_or(_mask(F.col("key"))).alias("word"))


def judge_urls(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """Verdict for every page.

    ``listed`` has a column ``key`` of canonical URLs to block (repeats and
    nulls are harmless).  Returns page_id, host, path, rule, verdict.
    """
    p = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    p = p.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"))
    keys = written(listed.select("key").where(F.col("key").isNotNull()).distinct(), "listed")
    blocks = blocks_for(keys.count())
    key = F.when(F.col("by_rule").isNull(), canonical(F.col("host"), F.col("path")))
    p = p.withColumn("key", key)
    # Pages that a rule decides, or that have no host, need no filter; the others
    # are dealt out by their block where the filter is too large to broadcast.
    filter_ = bloom(keys, blocks)
    p = p.withColumn("block", F.when(F.col("key").isNotNull(), _block(F.col("key"), blocks)).otherwise(-1 - F.pmod(F.xxhash64("path", "page_id"), F.lit(blocks))))
    p = p.join(F.broadcast(filter_) if blocks <= BROADCAST_BLOCKS else filter_, "block", "left")
    possible = F.col("key").isNotNull() & (F.col("word").bitwiseAND(_mask(F.col("key"))) == _mask(F.col("key")))
    p = p.withColumn("possible", F.coalesce(possible, F.lit(False)))
    # Pages that the filter clears never meet the join, so they are not shuffled.
    columns = ["page_id", "host", "path", "rule"]
    clear = p.where(~F.col("possible")).select(*columns, F.coalesce("by_rule", F.lit("allow")).alias("verdict"))
    hits = p.where("possible").join(keys.withColumn("listed", F.lit(True)), "key", "left")
    hits = hits.select(*columns, F.when(F.col("listed"), F.lit("block")).otherwise("allow").alias("verdict"))
    return clear.unionByName(hits)


def refetched(pages: DataFrame) -> DataFrame:
    """The production list: canonical URLs that two or more rows of ``pages`` share."""
    url = F.col("url")
    return pages.select(canonical(host(url), path(url)).alias("key")).where("key is not null").groupBy("key").count().where("count > 1").select("key")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, refetched(pages))


SQL = r"""
WITH p AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
k AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') END AS key FROM p),
l AS (SELECT key FROM k WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1),
r AS (SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM k)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN key IN (SELECT key FROM l) THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
