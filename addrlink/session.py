"""Spark session and lineage helpers.

The cascade and the label job are long chains of transformations; lineage is
cut with ``checkpoint()`` into the shared folder named by
``spark.checkpoint.dir``.  That setting is read from the session; a local
folder is only chosen when it is unset (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # labels are regex-heavy; keep generated code within the JIT limit
    "spark.sql.codegen.methodSplitThreshold": "1024",
}
# for one machine and little data only: similarity joins and regex chains are
# CPU-bound there, and AQE would merge their small shuffles into one task
_LOCAL = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}


def get_spark(app: str = "addrlink", cpus: int | str | None = None,
              shuffle_partitions: int | None = None, master: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the library relies on.

    ``master``: of a cluster; by default ``SPARK_MASTER`` or a local run on
    ``cpus`` cores.  Partition numbers and sizes are set for local runs only;
    a cluster keeps its own.
    """
    master = master or os.environ.get("SPARK_MASTER") or f"local[{cpus or os.environ.get('BENCH_CPUS', '8')}]"
    builder = SparkSession.builder.appName(app).master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if master.startswith("local"):
        cores = int(cpus or os.environ.get("BENCH_CPUS", "8"))
        for k, v in _LOCAL.items():
            builder = builder.config(k, v)
        builder = builder.config("spark.driver.memory", os.environ.get("ADDRLINK_DRIVER_MEM", "16g"))
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores * 2))
        builder = builder.config("spark.addrlink.spread", str(cores * 2))
    elif shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; a local one is chosen only on one machine and when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        conf_dir = tempfile.mkdtemp(prefix="addrlink-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint (survives executor loss; never ``localCheckpoint``).

    An eager Dataset checkpoint computes the rows once (measured: one
    evaluation per row), so no extra persist is needed around it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """Read one driver table.

    ``spread``: the caller does CPU-heavy work per row (regex chains on whole
    texts).  Where the session says so (``spark.addrlink.spread``, a number
    of partitions, set for local runs on small files) the rows are dealt out
    first; on a cluster the scan's own splits are used.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    n = int(spark.conf.get("spark.addrlink.spread", "0")) if spread else 0
    return df.repartition(n, df.columns[0]) if n else df


# Intermediate frames persisted inside one pass (label-level aggregates,
# similarity-join inputs), by the scope that is open: a scope releases its own
# frames only, so caches neither pile up over many passes nor end for another run.
_SCOPES: list[list[DataFrame]] = [[]]


@contextmanager
def scratch() -> Iterator[None]:
    """Frames of ``persist_scratch`` inside are released at the end: materialise what leaves it."""
    held: list[DataFrame] = []
    _SCOPES.append(held)
    try:
        yield
    finally:
        _SCOPES.pop()
        for df in held:
            df.unpersist()


def persist_scratch(df: DataFrame) -> DataFrame:
    """Persist ``df`` until the innermost ``scratch`` scope ends (outside of any: as long as the session)."""
    df = df.persist()
    _SCOPES[-1].append(df)
    return df
