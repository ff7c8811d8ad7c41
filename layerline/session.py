"""Session helpers: table access, checkpointing, run-wide defaults."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

from .errors import EngineError


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One Parquet table (file or folder) of a data directory."""
    return spark.read.parquet(f"{base}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoint() at the folder the cluster names in ``spark.checkpoint.dir``.

    Only where neither that setting nor a context-wide folder exists, and the master is local (tests), is a temporary folder
    used; on a cluster the setting is required, because a folder of one machine is lost with it.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise EngineError("spark.checkpoint.dir must name a shared folder on a cluster")
        named = tempfile.mkdtemp(prefix="layerline-")
    sc.setCheckpointDir(named)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` shuffled by ``keys`` over all cores: for rows that are little data and much work, whose number of tasks must not follow
    their bytes."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared checkpoint folder and cut its lineage. Spark removes the files when the frame is
    no longer used if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set, as it should be on a cluster."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
