"""Session defaults and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on. AQE re-plans joins from runtime sizes
# (a small side measured below the threshold becomes a broadcast, a skewed
# partition is split); the runtime bloom filter prunes the large cells side
# of a shuffle join against a small, selective anchor side before it moves.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                app_name: str = "cellfold") -> SparkSession:
    """Local session for tests and the bench; a cluster passes its own."""
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is.
    Only when it is unset (local tests) is a scratch folder made here.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            # a machine-local folder would not survive executor loss on a cluster
            raise ValueError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")
        conf_dir = tempfile.mkdtemp(prefix="cellfold-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss; never a local one)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """``df``, a table that grows with the corpus, for joins that deal both sides out by
    the key. Spark estimates a table by its compressed files and would broadcast millions
    of short rows, all held by the driver at once."""
    return df.hint("merge")


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """``df`` written once to the shared folder and read back: the cheaper way to cut
    lineage (a checkpoint computes its rows a second time to write them)."""
    path = scratch_path(df.sparkSession, f"{name}_{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spread(df.sparkSession.read.schema(df.schema).parquet(path))
