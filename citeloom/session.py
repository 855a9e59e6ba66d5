"""Session helpers: table access, staging in the shared folder, size-checked broadcasts."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows a lookup side may have before ``small_side`` leaves the join to a shuffle.
MAX_BROADCAST_ROWS = 100_000

_staged: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. The session's ``spark.checkpoint.dir`` wins; only where
    it is unset (local tests) a folder of this machine is used."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="citeloom-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def _drop_staged() -> None:
    for spark, path in _staged:
        try:
            remove_path(spark, path)
        except Exception:  # noqa: BLE001 - the session may be gone already
            return


atexit.register(_drop_staged)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete ``path`` through Hadoop's file system API, if it exists."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(target, True)


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Delete ``path`` when the driver ends."""
    _staged.append((spark, path))


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder once and return a scan of it.

    Cuts the plan history and survives the loss of executors; column pruning and filters reach the
    staged parquet files. The files are removed when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/citeloom-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    drop_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows (counted), else as it is,
    so that the planner shuffles both sides. Call it on staged or otherwise cheap frames."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
