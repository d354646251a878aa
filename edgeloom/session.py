"""Session set-up and lineage cuts.

Jobs take the session they are given. ``build_session`` is only a
convenience for tests, the bench and scripts: it turns on AQE (runtime
coalescing, skew-join splitting, broadcast conversion from measured sizes)
and keeps the web UI off.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Parquet codec of the tables that take the most disk
PACKED = "zstd"


def build_session(master: str | None = None, app: str = "edgeloom",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from the session (the context's directory or ``spark.checkpoint.dir``). A session that names none gets
    a folder below its warehouse, if executors share that too: all of them in a local session, else a warehouse
    in shared storage. On a cluster a warehouse that is a path of each machine is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not configured and not sc.master.startswith("local") and (":" not in warehouse or warehouse.startswith("file:")):
        raise ValueError(f"{CHECKPOINT_CONF} is not set, and executors may not share {warehouse}: name a shared folder")
    sc.setCheckpointDir(configured or f"{warehouse}/_checkpoints")
    return sc.getCheckpointDir()


def freeze(df: DataFrame, name: str = "frozen", packed: bool = False) -> DataFrame:
    """Write ``df`` as a parquet table under the checkpoint folder and read it back.

    Cuts lineage (a result that must not change if a stage is recomputed
    after an executor loss, e.g. numbered names, is read from storage, not
    recomputed) and gives the optimizer real size statistics, so a small
    frozen table can be broadcast from the plan's start. The folder comes
    from ``checkpoint_dir``: shared storage on a cluster. Spark makes one
    folder per application there; its tables are of no use after the job,
    and the operator of the cluster removes them with the folder. ``packed``: for the tables that take the most
    disk (edges, lines), written with a codec that packs tighter and takes more time.
    """
    path = fresh_folder(df.sparkSession, name)
    (df.write.option("compression", PACKED) if packed else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder name below the checkpoint folder that nobody has used."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
