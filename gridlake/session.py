"""Session settings and the shared scratch location."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# AQE re-plans joins from measured sizes, so small sides are broadcast only
# after their size is known and hot join partitions are split at run time.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Deduplication and window state of a large stream does not fit a heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(
    app: str = "gridlake", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """Session with the engine settings; ``conf`` adds to or replaces them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """All bucketing is in UTC, whatever session the caller brings."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else a folder
    of the warehouse. The rule is the same for local and cluster sessions."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def fresh_path(spark: SparkSession, label: str) -> str:
    """New, unused folder below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/gridlake/{label}-{uuid.uuid4().hex}"
