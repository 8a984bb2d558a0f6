"""Session settings the operators rely on at scale."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Split oversized join partitions even when that costs one more shuffle: a provider may hold a third of all rows.
_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

#: A join side is broadcast up to this size. Every broadcast passes through the driver, a report makes some thirty of
#: them, and a side's size is judged by its compressed files, which hold up to thirty times as much in memory.
BROADCAST_BYTES = 256 << 10
_THRESHOLD, _MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; cluster sizing (memory, shuffle partitions) is left to the session.

    Broadcast thresholds are only lowered: one that is smaller, or off, stays.
    """
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    # With a default given, an unset key reads as that; the measured sizes' threshold follows the other one where unset.
    for key, value in ((_THRESHOLD, spark.conf.get(_THRESHOLD)), (_MEASURED, spark.conf.get(_MEASURED, None))):
        if value and not value.startswith("-") and as_bytes(value) > BROADCAST_BYTES:
            spark.conf.set(key, str(BROADCAST_BYTES))
    return spark
