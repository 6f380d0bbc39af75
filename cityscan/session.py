"""Session defaults and small execution helpers.

ANSI mode stays on (the container default); operators use the tolerant
``try_*`` functions instead of turning it off.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app: str = "cityscan",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let the launcher decide; the
    shuffle partition count is then left to AQE coalescing.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (distributed) folder there and we only read it.
    Only when it is unset (local tests) do we set one: ``fallback`` or a fresh
    scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if fallback is None and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    path = fallback or tempfile.mkdtemp(prefix="cityscan-ckpt-")
    os.makedirs(path, exist_ok=True)
    sc.setCheckpointDir(path)
    return path


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a table read from a few small files over the session's cores.

    For entry points that know their input to be small; operators never call it.
    It looks at the number of files only and runs no job. Anything not read
    from files, or read from at least as many files as cores, is returned as it is.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    files = len(df.inputFiles())
    return df.repartition(want) if 0 < files < want else df


def materialize(df: DataFrame) -> DataFrame:
    """Write a bounded intermediate (a parsed dimension table) to the shared
    checkpoint folder and continue from the written copy.

    Cuts lineage, so a lost executor re-reads files instead of replaying
    the parse, and keeps later plans small. Use only for data whose size is
    bounded by a dimension (zones, sites), never for the fact stream.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
