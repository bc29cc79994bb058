"""Session settings that suit the engine's plans."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # A run has more generated classes than the default cache of 100 holds;
    # with a smaller cache every task compiles its operators anew.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # Noting the caller of every column takes a third of the time a plan takes to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def session(name: str = "natalis", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the engine's settings; ``settings`` use ``__`` for dots in names."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
