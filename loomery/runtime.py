"""Session helpers shared by every operator: reading tables, spreading work, samples, cutting lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent.parent


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` of the data folder, as Spark reads it (columns are pruned by Catalyst)."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, unless they find it anyway (same folder or PYTHONPATH)."""
    paths = os.environ.get("PYTHONPATH", "").split(":")
    if os.getcwd() == str(ROOT) or str(ROOT) in paths or getattr(spark, "_loomery_shipped", False):
        return
    to = Path(tempfile.mkdtemp()) / "loomery_src.zip"  # read by the driver only; Spark serves it to the workers
    with zipfile.ZipFile(to, "w") as z:
        for p in (ROOT / "loomery").rglob("*.py"):
            z.write(p, p.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(to))
    spark._loomery_shipped = True


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share before a CPU-heavy Python stage.

    A scan with at least as many splits as cores (any large table) stays as it is, without a shuffle;
    only an input of a few small files is dealt out round-robin.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() * 2 >= cores else df.repartition(cores)


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """About n rows (all, if there are no more), the same at each run, taken evenly by the hash of a row's key.

    Each task keeps its share by itself; nothing is sorted or gathered beyond the sample.
    """
    total = df.count()
    if total <= n:
        return df
    return df.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int((1 << 30) * n / total))


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows, computed once and written to the shared folder of the session's checkpoints.

    A cluster names the folder in ``spark.checkpoint.dir``; only a local session may get one of its own.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir names no folder that all executors share")
            folder = tempfile.mkdtemp()
        sc.setCheckpointDir(folder)
    return df.checkpoint()


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share, beside the checkpoints."""
    checkpointed(spark.range(0))
    return f"{spark.sparkContext.getCheckpointDir()}/tables-{uuid.uuid4().hex}"
