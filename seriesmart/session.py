"""Session helpers and the shared working folder.

Jobs that land files, keep ledgers or publish versions write below the
folder the cluster names in ``spark.checkpoint.dir`` (a shared file system on
a cluster). A folder is only created here when the session has none, which is
the local/test case.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for local runs (tests, bench). On a cluster the session is built by
# the platform; the library itself never depends on these values.
LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "seriesmart") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session, None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return None


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set one only when unset."""
    sc = _context(spark)
    d = sc.getCheckpointDir() if sc is not None else None
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d and sc is None:
        return d
    if not d and sc is not None:
        d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        master = sc.master if sc is not None else "local"
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # Local runs and tests only: a cluster session names a shared folder.
        d = tempfile.mkdtemp(prefix="seriesmart-ckpt-", dir="/tmp")
        if sc is None:
            spark.conf.set("spark.checkpoint.dir", d)
            return d
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its (Hadoop) file system."""
    sc = _context(spark)
    if sc is not None:
        jvm = sc._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(sc._jsc.hadoopConfiguration()).exists(p)
    try:
        spark.read.format("binaryFile").load(path).limit(0).collect()
        return True
    except Exception:  # noqa: BLE001 - missing path
        return False


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that a job of this library has written (nothing under Spark Connect)."""
    sc = _context(spark)
    if sc is not None:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def make_path(spark: SparkSession, path: str) -> None:
    """Create a folder on its (Hadoop) file system, if it is not there."""
    sc = _context(spark)
    if sc is not None:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).mkdirs(p)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    return f"{shared_dir(spark).rstrip('/')}/seriesmart/{name}-{uuid.uuid4().hex[:12]}"
