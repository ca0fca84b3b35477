"""Session helpers: table access, lineage cutting and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest estimated size in bytes of a side that may carry a broadcast hint.
BROADCAST_LIMIT_BYTES = 8 << 20


def local_session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder and drop its lineage.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; only a local session without it (tests) gets a folder
    of its own.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.split("[")[0] == "local":
            raise ValueError("a cluster must name a shared folder in spark.checkpoint.dir")
        sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "feedloom-checkpoints"))
    return df.checkpoint(eager=True)


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; very large where it knows nothing (it errs upwards)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its estimated size is within ``limit``; otherwise ``df`` itself, so that the
    planner shuffles."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def ship(spark: SparkSession) -> None:
    """Makes this package importable by the session's Python workers, once a context.

    The driver packs it and serves it to the executors itself, so that nothing need be installed there.
    """
    sc = spark.sparkContext
    if getattr(sc, "_feedloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    packed = Path(tempfile.mkdtemp(prefix="feedloom-")) / "feedloom.zip"
    with zipfile.ZipFile(packed, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(packed))
    sc._feedloom_shipped = True
