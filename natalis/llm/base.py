"""What the operators share: tables, the shared folder, and connected groups of linked ids."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis.sources.tables import shared_folder

#: Links that a task of ``connected`` reads, about.
LINKS_PER_TASK = 50_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read from there, without what led to them."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet to the shared folder and read from there."""
    where = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(where)
    return df.sparkSession.read.parquet(where)


def gathered(df: DataFrame, rows: int, each: int) -> DataFrame:
    """The table in no more partitions than ``rows`` rows fill with ``each``: a small one makes few tasks and files in later steps."""
    return df.coalesce(max(1, -(-rows // each)))


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]


def bucket(id_: Column, n: int) -> Column:
    """A number from 0 to n - 1 for every id, null included."""
    return F.pmod(F.xxhash64(id_), F.lit(n)).cast("int")


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): for every linked id the smallest id that it reaches.

    Large-star and small-star rounds (every id tells its larger neighbours, then its smaller ones, the
    smallest id it knows) until no link changes; a hub's links are rows of the shuffle, and what meets in
    one aggregate is a minimum. Each round's links are cut off from their lineage in the shared folder.
    """
    pairs = links.select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high")).where("low <> high").distinct()
    pairs = cut(pairs)
    known = _told(pairs)
    while True:
        few = partial(gathered, rows=known[0], each=LINKS_PER_TASK)
        pairs = few(pairs)
        # large star: larger neighbours are linked with the smallest neighbour
        both = pairs.select(F.col("low").alias("u"), F.col("high").alias("v")).union(pairs.select(F.col("high").alias("u"), F.col("low").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("low"), F.col("v").alias("high"))
        large = few(few(large.where("low <> high")).distinct())
        # small star: smaller neighbours and the id itself are linked with the smallest
        least = few(large.groupBy(F.col("high").alias("u")).agg(F.min("low").alias("m")))
        small = few(large.select(F.col("high").alias("u"), F.col("low").alias("v")).join(least, "u"))
        small = small.select(F.col("m").alias("low"), F.col("v").alias("high")).union(least.select(F.col("m").alias("low"), F.col("u").alias("high")))
        pairs = cut(few(small.where("low <> high").distinct()))
        now = _told(pairs)
        if now == known:
            heads = pairs.select(F.col("low").alias("id"), F.col("low").alias("component")).distinct()
            return pairs.select(F.col("high").alias("id"), F.col("low").alias("component")).union(few(heads))
        known = now


def _told(pairs: DataFrame) -> tuple[int, int | None]:
    """How many pairs there are and a sum by which their set is told from another."""
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first())
