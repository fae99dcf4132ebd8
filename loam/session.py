"""Session helpers: building a session, locating the shared checkpoint folder,
reading the parquet tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the package relies on.  AQE re-plans joins and coalesces shuffle
# partitions at run time; UTC keeps timestamp arithmetic engine-independent.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "loam",
              shuffle_partitions: int | None = None,
              extra_conf: dict | None = None) -> SparkSession:
    """Return (or create) a session with the package defaults.

    On a cluster ``master`` stays ``None`` and the launcher decides; tests pass
    ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for reliable checkpoints and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or the context's checkpoint
    dir).  Without either, a local session (tests) gets a temporary folder; any
    other session fails, since its executors share no local folder.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="loam-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/loam-{name}-{uuid.uuid4().hex[:10]}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the parquet tables (a file or a directory of part files)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_tables(spark: SparkSession, sf_dir: str, names) -> dict[str, DataFrame]:
    return {n: read_table(spark, sf_dir, n) for n in names}


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Store an intermediate that several later jobs read: written once as
    Parquet to the shared folder; the returned frame reads the files, with
    their sizes known to the planner."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
