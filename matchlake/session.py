"""Session helpers.

The library never picks machine-local folders on a cluster: anything that has
to be written between jobs (lineage cuts, scratch tables) goes under the
shared folder named by ``spark.checkpoint.dir``.  Only when that is unset *and*
the master is local (tests, laptops) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the transforms are written for; on a cluster also set
# spark.sql.adaptive.coalescePartitions.initialPartitionNum to the number of
# partitions that the largest shuffle needs (AQE coalesces the others).  AQE re-plans joins and splits
# skewed sort-merge partitions at runtime; ``requireAllClusterKeysForCoPartition``
# lets the role joins on (name, match_id[, salt]) reuse one partitioning on
# (match_id[, salt]) instead of re-shuffling the delivery table per role.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "matchlake", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Of those, the settings that may be changed on a running session.
_RUNTIME_CONF = ("spark.sql.requireAllClusterKeysForCoPartition", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold")


def apply_settings(spark: SparkSession) -> SparkSession:
    """Give a session made elsewhere the runtime settings the plans are written
    for.  Called by applications (the registered queries, the bench), never by
    an operator: results do not depend on them, exchange counts do."""
    for key in _RUNTIME_CONF:
        spark.conf.set(key, RECOMMENDED_CONF[key])
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/ABFS)")
    path = tempfile.mkdtemp(prefix="matchlake-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


_SCRATCH: dict[str, list[str]] = {}


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a scratch folder and read it back: fixes its values, cuts
    the lineage, and lets Spark know its size."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables of this application (frames built on them end
    with it); returns how many there were.  Call it once results are written."""
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)
