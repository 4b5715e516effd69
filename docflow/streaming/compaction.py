"""Snapshots of the streamed ledger (T2): log-structured compaction with a commit marker.

``stream_ledger`` appends the updated keys of every micro-batch. A snapshot holds the latest row
of every key up to a batch; readers merge the newest committed snapshot with the batches after it, so
neither reading nor the next compaction goes over the whole log again. A snapshot counts once its marker
is written, after its rows and its key filter: a compaction that fails leaves nothing that is read.
Batches that are replayed after a snapshot that holds them are not read again.

Keys that a batch changed are few: a Bloom filter of them lets the other rows of the snapshot through without
a shuffle. The snapshot's own filter does the same for new ids that are not in the ledger yet.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.operators import bloom

KEY = ["ack_id", "year"]
ROWS = "ack_id string, year int, status string, ts timestamp, seq long"
MARKER = "_COMMITTED"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, path: str, prefix: str) -> dict[int, str]:
    """Numbered folders ``<prefix>=<n>`` under a path: one entry a snapshot or a batch."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return {int(n.split("=", 1)[1]): f"{path.rstrip('/')}/{n}" for n in names if n.startswith(prefix + "=")}


@dataclass
class Snapshot:
    """``rows``: the latest row of every key up to and with batch ``upto``."""

    upto: int
    rows: DataFrame
    keys: bloom.BloomFilter


def latest_snapshot(spark: SparkSession, root: str) -> Snapshot | None:
    """The newest committed snapshot under ``root``, if any."""
    for n, path in sorted(_children(spark, root, "snapshot").items(), reverse=True):
        fs, marker = _path(spark, f"{path}/{MARKER}")
        if fs.exists(marker):
            return Snapshot(n, spark.read.schema(ROWS).parquet(f"{path}/rows"), bloom.load(spark, f"{path}/keys"))
    return None


def _changes(spark: SparkSession, log: str, after: int) -> DataFrame:
    """The latest row of every key that batches after ``after`` changed; only their folders are read."""
    batches = [p for n, p in sorted(_children(spark, log, "batch_id").items()) if n > after]
    if not batches:
        return spark.createDataFrame([], ROWS)
    rows = spark.read.schema(ROWS).parquet(*batches)
    last = F.max_by(F.struct("status", "ts", "seq"), F.struct("ts", "seq")).alias("last")
    return rows.groupBy(*KEY).agg(last).select(*KEY, "last.*")


def read_current(spark: SparkSession, log: str, snapshots: str) -> DataFrame:
    """The current row of every document, ``ack_id, year, status, ts, seq``: equal to the whole log's,
    whatever has been compacted. Null keys are keys like others."""
    base = latest_snapshot(spark, snapshots)
    if base is None:
        return _changes(spark, log, -1)
    changed = _changes(spark, log, base.upto)
    if not any(n > base.upto for n in _children(spark, log, "batch_id")):
        return base.rows
    old = base.rows.select(*KEY, F.struct("status", "ts", "seq").alias("old"))
    filt = bloom.build(changed, *KEY)
    told = filt.split(old, *KEY)
    kept = told.where(~F.col("_maybe")).select(*KEY, "old.*")
    # a late transition may be older than the snapshot's: the newer of the two stays
    met = told.where("_maybe").select(*KEY, "old.*").unionByName(changed)
    last = F.max_by(F.struct("status", "ts", "seq"), F.struct("ts", "seq")).alias("last")
    return kept.unionByName(met.groupBy(*KEY).agg(last).select(*KEY, "last.*"))


def compact(spark: SparkSession, log: str, snapshots: str) -> int | None:
    """Write a snapshot up to the last batch of the log and commit it; returns that batch, or None if
    there is nothing new. A snapshot of the same batch left by a failed run is overwritten."""
    upto = max(_children(spark, log, "batch_id"), default=None)
    base = latest_snapshot(spark, snapshots)
    if upto is None or (base is not None and base.upto >= upto):
        return None
    path = f"{snapshots.rstrip('/')}/snapshot={upto}"
    read_current(spark, log, snapshots).hint("rebalance").write.mode("overwrite").parquet(f"{path}/rows")
    rows = spark.read.schema(ROWS).parquet(f"{path}/rows")
    # room for as many keys again: later filters of this size merge into it
    bloom.build(rows, *KEY, n_blocks=bloom.blocks_for(2 * rows.count())).save(f"{path}/keys")
    fs, marker = _path(spark, f"{path}/{MARKER}")
    fs.create(marker, True).close()
    return upto


def vacuum(spark: SparkSession, log: str, snapshots: str, keep: int = 2) -> int:
    """Delete batches that the oldest of the ``keep`` newest committed snapshots holds, and the
    snapshots before it; returns the number of folders deleted. Readers of a kept snapshot lose nothing."""
    found = _children(spark, snapshots, "snapshot")
    committed = [n for n, p in sorted(found.items(), reverse=True) if (f := _path(spark, f"{p}/{MARKER}"))[0].exists(f[1])]
    if len(committed) < keep:
        return 0
    oldest = committed[keep - 1]
    gone = [p for n, p in found.items() if n < oldest] + [p for n, p in _children(spark, log, "batch_id").items() if n <= oldest]
    for path in gone:
        fs, p = _path(spark, path)
        fs.delete(p, True)
    return len(gone)


def new_ids(spark: SparkSession, ids: DataFrame, log: str, snapshots: str) -> DataFrame:
    """The rows of ``ids`` (with ``ack_id`` and ``year``) whose document the ledger does not hold: the filter stored
    with the snapshot, merged with that of later batches, lets most new ids skip the shuffle."""
    base = latest_snapshot(spark, snapshots)
    current = read_current(spark, log, snapshots).select(*KEY)
    if base is None:
        return bloom.anti_join(ids, current, KEY)
    filt = base.keys.merge(bloom.build(_changes(spark, log, base.upto), *KEY, n_blocks=base.keys.n_blocks))
    return bloom.anti_join(ids, current, KEY, filt)
