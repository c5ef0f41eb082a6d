"""Session construction and the runtime settings the operators rely on."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every plan in this package assumes. They are session-scoped and
# safe to set on a running session.
RUNTIME_CONF = {
    # Event-time calendar is UTC only.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins on (card_id, bucket, x) may reuse a hash(card_id, bucket) layout instead of
    # re-shuffling the large side on all join keys.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # HotSpot interprets methods of more bytes than that; a stage with such a method (the 27
    # features, for one) runs operator by operator instead, in methods that are compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "cardwise",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the settings this package expects.

    ``master`` defaults to ``local[$BENCH_CPUS or *]``; on a cluster pass ``None`` through
    spark-submit and the cluster's master is used.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and not os.environ.get("SPARK_MASTER"):
        master = f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.memory": "16g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or 8),
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        **RUNTIME_CONF,
    }
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return configure(spark)


#: Checkpoint folder of each local application that came without one.
_LOCAL_FOLDERS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting is always used when present. Only when it is unset in local mode
    (tests) is a private folder under ``/tmp`` chosen, once per application; a cluster without the
    setting is an error, since each host would have a folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        context = spark.sparkContext
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all hosts share")
        # a core setting cannot be changed on a running session
        path = _LOCAL_FOLDERS.setdefault(context.applicationId, f"/tmp/cardwise-ckpt-{uuid.uuid4().hex[:8]}")
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory for materialised tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:10]}"


def write_once(df, name: str):
    """``df`` written under the shared checkpoint folder and read back with its schema.

    Every reader of the result sees the same rows and the same generated values (partition
    numbers, for one), whatever columns it asks for."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df, spark: SparkSession | None = None):
    """Reliable checkpoint into the shared checkpoint folder.

    Cuts lineage (a lost executor recomputes from the checkpoint, not from the scan) and
    keeps the physical partitioning, so later windows and joins on the same keys do not
    shuffle again. Use with a fixed-count ``repartition(n, ...)`` so AQE cannot coalesce the
    layout away.
    """
    spark = spark or df.sparkSession
    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


_PERSISTED: list = []


def release_persisted() -> int:
    """Unpersist every table cached by :func:`persist_partitioned`; returns how many.

    Call once the DataFrames built on them (e.g. a feature table) are written or no longer
    needed; other cached tables of the session are left alone."""
    n = 0
    while _PERSISTED:
        _PERSISTED.pop().unpersist()
        n += 1
    return n


def persist_partitioned(df):
    """Persist ``df`` so that readers of the cache see its hash partitioning.

    The cached plan is built with adaptive execution off for that one plan: an adaptive
    cached plan reports no output partitioning, and every reader would re-shuffle it.
    Queries reading the cache still run adaptively.
    """
    from pyspark import StorageLevel

    spark = df.sparkSession
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        out = df.persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        spark.conf.set(key, before)
    _PERSISTED.append(out)
    return out
