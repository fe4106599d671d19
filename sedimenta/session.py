"""Session settings the plans are written for. Sizes of the cluster stay the caller's."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Reference results are in UTC; dates must not move with the machine's zone.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: joins by measured size, skewed partitions split, small ones merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key's partition even where a later step then has to shuffle once more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # The JVM never compiles a method above 8,000 bytes. A stage that parses many columns can
    # pass that, and then runs faster operator by operator than fused and interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


def compile_by_operator(spark: SparkSession) -> None:
    """The limit on compiled methods for a session that was built without `configure`. It changes
    how a plan runs, never its rows; a lower limit the caller has chosen stays."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(limit)) > int(SETTINGS[limit]):
        spark.conf.set(limit, SETTINGS[limit])
