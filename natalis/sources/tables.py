"""Result tables and files."""

from __future__ import annotations

import tempfile
from pathlib import PurePath
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from natalis.lookups import CODE_SCHEMA, SCHEMAS, Lookups, read_csv

# Result columns and types; "datetime" of the source design holds whole days.
EPISODE_COLUMNS = (
    ("person_id", "bigint"),
    ("episode_start_date", "date"),
    ("episode_end_date", "date"),
    ("start_method", "string"),
    ("original_outcome", "string"),
    ("episode", "bigint"),
    ("outcome", "string"),
    ("episode_length", "int"),
)


def write_lookups(spark: SparkSession, lookups: Lookups, schema: str) -> None:
    """Store the lookups as tables of ``schema``, replacing those present."""
    for name, table in lookups.tables(spark).items():
        table.write.mode("overwrite").saveAsTable(f"{schema}.{name}")


def load_lookups(spark: SparkSession, folder: str, schema: str) -> None:
    """Store every CSV file of ``folder`` as a table of ``schema`` under its name, replacing those present.

    The three lookups and the code set ``pregnancy_concepts`` have fixed types; those of other files are inferred.
    """
    known = SCHEMAS | {"pregnancy_concepts": CODE_SCHEMA}
    for file in spark.read.text(f"{folder.rstrip('/')}/*.csv").inputFiles():
        name = PurePath(unquote(file)).stem
        read_csv(spark, folder, name, known.get(name)).write.mode("overwrite").saveAsTable(f"{schema}.{name}")


def create_episodes(spark: SparkSession, table: str) -> None:
    """An empty result table, replacing the one present."""
    columns = ", ".join(f"{name} {kind}" for name, kind in EPISODE_COLUMNS)
    spark.createDataFrame([], columns).write.mode("overwrite").saveAsTable(table)


def write_episodes(episodes: DataFrame, table: str, mode: str = "overwrite") -> None:
    """Store episodes as a table; ``append`` adds them to those of earlier runs."""
    shaped = episodes.selectExpr(*(f"CAST({name} AS {kind}) AS {name}" for name, kind in EPISODE_COLUMNS))
    shaped.write.mode(mode).saveAsTable(table)


def read_episodes(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).select(*(name for name, _ in EPISODE_COLUMNS))


def write_csv(summary: DataFrame, path: str) -> None:
    summary.write.mode("overwrite").option("header", True).csv(path)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, ``spark.checkpoint.dir``.

    Only a local session without one uses a temporary folder; on a cluster it must be set.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and context.master.startswith("local"):
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        if folder is None:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut_lineage(table: DataFrame) -> DataFrame:
    """Store ``table`` in the shared checkpoint folder and go on from there."""
    shared_folder(table.sparkSession)
    return table.checkpoint()
