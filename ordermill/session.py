"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan at run time: merge small shuffle partitions, split skewed join partitions,
    # switch to a broadcast join when the measured side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keys that a filter leaves thin out the other side of a join before its shuffle. The defaults
    # stop at 10 MB of keys and 8 MB of filter, far below a month of a large shop.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "10GB",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "50000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "536870912",
    # A sum or cast that does not fit raises instead of wrapping or turning NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str = "ordermill", master: str | None = None, **settings: str
) -> SparkSession:
    """A session with the settings above; ``settings`` adds or overrides entries.

    Keys use double underscores for dots: ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    extra = {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in (SETTINGS | extra).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
