"""Session settings the jobs rely on, for programs that create their own session."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: AQE coalesces small shuffle partitions, splits skewed ones of sort-merge joins and swaps in a
#: broadcast join once a side has been measured below the threshold. Nothing in the package hints a
#: broadcast of data that can grow, so these settings decide.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app_name: str = "clinspark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` uses ``__`` for the dots of a setting's name."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
