"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "candlelake", **conf: str) -> SparkSession:
    """A UTC session; master, memory and shuffle width come from spark-submit or ``conf``."""
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Every timestamp in the lake is UTC, so epoch maths must not see a local zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, for sessions that were started without ``--py-files``."""
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="candlelake-package-")) / "candlelake.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's part of the cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine: on a cluster
    the executors would not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="candlelake-")
        spark.sparkContext.setCheckpointDir(base)
    application = spark.sparkContext.applicationId
    return f"{base.rstrip('/')}/{application}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result survives lost executors, is computed once, and has a size the
    optimizer knows from the files. A join against it is therefore broadcast only
    below ``spark.sql.autoBroadcastJoinThreshold`` and shuffled above it.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
