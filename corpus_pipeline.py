"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis.llm.base import cut, shared_folder, table
from natalis.llm.curriculum import ordered, plan, repeating
from natalis.llm.language import identify, learn
from natalis.llm.near import BROADCAST_IDS, near_duplicates
from natalis.llm.postings import contamination
from natalis.llm.repeats import remove_repeats


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents whose id is not among ``ids`` (a column ``id``).

    The ids are stored and counted: up to ``BROADCAST_IDS`` of them (some 32 MB) go to every task, so that
    no text is shuffled; beyond, the join shuffles.
    """
    ids = cut(ids.select("id").distinct())
    gone = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return docs.alias("d").join(gone.alias("g"), F.col("d.doc_id").eqNullSafe(F.col("g.id")), "left_anti")


def once(docs: DataFrame) -> DataFrame:
    """The documents with rows of equal id and text, nulls included, taken once; only texts of repeated ids are shuffled."""
    repeated = cut(docs.groupBy(F.col("doc_id").alias("id")).count().where("count > 1").select("id"))
    rows = repeated.count()
    if not rows:
        return docs
    ids = F.broadcast(repeated) if rows <= BROADCAST_IDS else repeated
    again = docs.alias("d").join(ids.alias("g"), F.col("d.doc_id").eqNullSafe(F.col("g.id")), "left_semi")
    return without(docs, repeated).union(cut(again.dropDuplicates(["doc_id", "text"])))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language mixture explains them; those without a letter or of no learned language go.

    A null or empty text has no letter and goes; rows are judged one by one, whatever their ids; of an empty table nothing is kept.
    """
    model = learn(docs)
    return identify(docs, model).where("known").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: the one with the smallest id, once if its row is repeated."""
    docs = once(docs)
    return without(docs, near_duplicates(docs).where("not kept"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out words of repeated windows; texts that lose none stay as they are, documents that lose all go.

    Rows are told apart by id and text: those that agree in both lose all words or none, so none is multiplied.
    """
    row = F.concat_ws(" ", F.col("doc_id").cast("string"), F.xxhash64("text").cast("string"))
    keyed = docs.withColumn("_row", row)
    found = remove_repeats(keyed, "_row").where("n_removed > 0").select("id", "kept", (F.col("n_words") > F.col("n_removed")).alias("left"))
    rows = keyed.alias("d").join(found.alias("f"), F.col("d._row") == F.col("f.id"), "left").where("f.left is null or f.left")
    kept = F.col("f.kept")
    changed = {
        "text": F.coalesce(kept, F.col("d.text")).alias("text"),
        "n_chars": F.when(kept.isNull(), F.col("d.n_chars")).otherwise(F.char_length(kept)).cast("long").alias("n_chars"),
    }
    return rows.select(*(changed.get(c, F.col(f"d.`{c}`")) for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that benchmark windows contaminate.

    Rows are told apart by id and text, so that of rows of equal id only the contaminated ones go, and rows without an id are
    judged like others; a null or empty text has no words and stays.
    """
    found = contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    found = cut(found.select("id", "text_hash").distinct())
    gone = F.broadcast(found) if found.count() <= BROADCAST_IDS else found
    same = F.col("d.doc_id").eqNullSafe(F.col("g.id")) & (F.xxhash64("d.text") == F.col("g.text_hash"))
    return docs.alias("d").join(gone.alias("g"), same, "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order: documents as often as the curriculum takes them, sorted by position.

    A row that stands twice counts once; null and empty texts have no words and are never taken; a null source is a source of its own.
    """
    return ordered(once(docs), plan(docs, repeating(5, 2, 1)))


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and reread as the next one's."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs


#: The curriculum of the last stage and the likelihoods of the first have no SQL.
ORACLE_SQL = None
