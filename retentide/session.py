"""Session settings the engine relies on."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def require_utc(spark: SparkSession) -> SparkSession:
    """Days are UTC days everywhere, so the session has to read timestamps as UTC; it is set to."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("retentide")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder that all executors share: below spark.checkpoint.dir or, where that is not
    set, below the warehouse."""
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    shared = spark.conf.get("spark.checkpoint.dir", f"{warehouse}/_shared")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
