"""Replay a table as a file stream in event order (the data side of a replayer).

The table is range-partitioned on (ts_ms, txn_id) into ``n_files`` JSON files, each a
contiguous slice of event time; file modification times are then set in slice order so the
file source (one file per micro-batch) delivers the slices in event order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwise.schema import TXN_COLUMNS


def write_replay_files(df: DataFrame, path: str, n_files: int, fmt: str = "json") -> list[str]:
    """Write ``df`` as ``n_files`` event-ordered files (all fields as text, like the wire)."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in TXN_COLUMNS])
    ordered = text.repartitionByRange(n_files, F.col("ts_ms").cast("long"), "txn_id")
    ordered.write.mode("overwrite").format(fmt).save(path)
    return _order_mtimes(df.sparkSession, path)


def _order_mtimes(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(
        st.getPath().toString() for st in fs.listStatus(hpath) if st.getPath().getName().startswith("part-")
    )
    base = 1_000_000_000_000
    for i, name in enumerate(names):  # one file per range slice, named in slice order
        fs.setTimes(jvm.org.apache.hadoop.fs.Path(name), base + i * 1000, -1)
    return names


def redeliver(spark: SparkSession, file_path: str, new_name: str, after_ms: int = 500) -> str:
    """Copy a replay file under a new name with a later modification time (a redelivery)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src = jvm.org.apache.hadoop.fs.Path(file_path)
    fs = src.getFileSystem(conf)
    dst = jvm.org.apache.hadoop.fs.Path(src.getParent(), new_name)
    jvm.org.apache.hadoop.fs.FileUtil.copy(fs, src, fs, dst, False, conf)
    fs.setTimes(dst, fs.getFileStatus(src).getModificationTime() + after_ms, -1)
    return dst.toString()


def set_arrival_order(spark: SparkSession, names: list[str], order: list[int]) -> None:
    """Deliver replay files in ``order`` (indexes into ``names``) by their modification times."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for rank, i in enumerate(order):
        p = jvm.org.apache.hadoop.fs.Path(names[i])
        p.getFileSystem(conf).setTimes(p, 1_000_000_000_000 + rank * 1000, -1)


def write_flush_row(spark: SparkSession, folder: str, ts_ms: int, arrival_rank: int) -> str:
    """Append one sentinel transaction (card ``__flush__``) at ``ts_ms`` as the last file, to
    move the watermark past a finite input's last events."""
    import json

    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(folder, "zz-flush.json")
    fs = p.getFileSystem(conf)
    row = {c: None for c in TXN_COLUMNS}
    row.update(txn_id="__flush__", card_id="__flush__", ts_ms=str(ts_ms), amount="0", mcc="NA", merchant_id="", lat="0", lon="0")
    out = fs.create(p, True)
    out.write(bytearray((json.dumps(row) + "\n").encode()))
    out.close()
    fs.setTimes(p, 1_000_000_000_000 + arrival_rank * 1000, -1)
    return p.toString()
