"""URL lists: a blocked Bloom filter in front of an exact hash join.

A listed entry is a host and a path; it fits its host and all subdomains where the URL's path starts with
the entry's. A page asks for every (host suffix, path prefix) that could be listed: suffixes have as many labels
as some entry's host, prefixes a length that occurs in the list, so that a long host costs no more than its bytes. The filter has blocks of 512 bits, a key sets one
bit in each of the eight 64-bit words of its block; the bits are set by a distributed OR. Keys that pass
are joined with the list itself, which removes all false positives, and the longest entry wins.

The filter takes some 16 bits for each listed entry. Up to ``BROADCAST_BLOCKS`` blocks (64 MB) it is
broadcast, beyond that it is joined by block; the result is the same.

Defined results: a null URL or one without ``://`` has an empty host and path and fits no entry; of two
entries of equal length that fit, the one with the longer host wins; repeated entries with different
verdicts are an error; an empty list allows everything. Only the id and the URL are read, so other columns
don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis.llm.base import cut, table

KEYS_PER_BLOCK = 32
BROADCAST_BLOCKS = 1 << 20
WORDS = 8


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def canonical(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)), F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _block(hash_: Column, blocks: int) -> Column:
    return F.pmod(hash_, F.lit(blocks)).cast("long")


def _bit(hash_: Column, word: int) -> Column:
    """The bit of a key in one word of its block: six bits of a second hash of the key."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(F.xxhash64(hash_, F.lit(17)), 6 * word), F.lit(64)).cast("int"))


def bloom(keys: DataFrame, hash_: str, blocks: int) -> DataFrame:
    """The non-empty blocks: ``block`` and eight words."""
    hashes = F.col(hash_)
    return keys.groupBy(_block(hashes, blocks).alias("block")).agg(*[F.bit_or(_bit(hashes, k)).alias(f"w{k}") for k in range(WORDS)])


def judge(pages: DataFrame, listed: DataFrame, id_: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) for every page. ``listed`` has (host, path, verdict)."""
    entries = cut(listed.select("host", "path", "verdict").distinct())
    if entries.groupBy("host", "path").count().where("count > 1").limit(1).count():
        raise ValueError("the list has an entry with two verdicts")
    count = entries.count()
    blocks = max(1, -(-count // KEYS_PER_BLOCK))
    lengths = sorted(r[0] for r in entries.select(F.length("path")).distinct().collect())  # path lengths, not paths
    host, path = canonical(F.col(url))
    pages = pages.select(F.col(id_).alias("id"), host.alias("host"), path.alias("path"))
    depths = sorted(r[0] for r in entries.select(F.size(F.split("host", r"\.", -1))).distinct().collect())  # numbers of labels, not hosts
    # the last k labels are what follows the k-th dot from the end; a host of fewer dots is one suffix, the whole, for its own number of labels
    dots = F.length("host") - F.length(F.replace(F.col("host"), F.lit(".")))
    suffixes = F.transform(F.filter(F.array(*[F.lit(k) for k in depths]).cast("array<int>"), lambda k: k <= dots + 1), lambda k: F.call_function("substring_index", F.col("host"), F.lit("."), -k))
    prefixes = F.transform(F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path")), lambda n: F.substr(F.col("path"), F.lit(1), n))
    asked = pages.select("id", "host", "path", F.explode(suffixes).alias("h")).where("h <> ''")
    asked = asked.select("id", "host", "path", "h", F.explode(prefixes).alias("p"))
    key = F.xxhash64("h", "p")
    asked = asked.withColumn("key", key).withColumn("block", _block(F.col("key"), blocks))
    bits = bloom(entries.withColumn("key", F.xxhash64("host", "path")), "key", blocks)
    if blocks <= BROADCAST_BLOCKS:
        bits = F.broadcast(bits)
    possible = asked.join(bits, "block")
    for k in range(WORDS):
        possible = possible.where(F.col(f"w{k}").bitwiseAND(_bit(F.col("key"), k)) != 0)
    hits = possible.select("id", "host", "path", "h", "p").join(entries.select(F.col("host").alias("h"), F.col("path").alias("p"), "verdict"), ["h", "p"])
    best = F.max_by(F.struct("h", "p", "verdict"), F.struct(F.length("h") + F.length("p"), F.length("h")))
    hits = hits.groupBy("id", "host", "path").agg(best.alias("best"))
    same = F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.host") == F.col("b.host")) & (F.col("a.path") == F.col("b.path"))
    out = pages.alias("a").join(hits.alias("b"), same, "left")
    return out.select("a.id", "a.host", "a.path", F.concat("b.best.h", "b.best.p").alias("rule"), F.coalesce("b.best.verdict", F.lit(default)).alias("verdict"))


#: The contract's list.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op4_url_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the four rules; a page on no list is allowed."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(table(spark, sf_dir, "pages"), rules).withColumnRenamed("id", "page_id")


OP4_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut)
SELECT page_id, host, path,
  CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
       WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
       WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
       WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule,
  CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'allow'
       WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'block'
       WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'allow'
       WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'block' ELSE 'allow' END AS verdict
FROM parts
"""
