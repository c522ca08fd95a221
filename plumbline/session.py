"""Session settings the operators rely on, and the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings. The skew-join settings let Spark split a hot partition of
# an ordinary join at run time; operators whose build side is an aggregate
# (which Spark does not split) use plumbline.operators.skew instead.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str = "8", partitions: int = 8, memory: str = "8g", **settings: str) -> SparkSession:
    """A single-machine session for tests and the bench. Further settings are given
    with underscores for dots."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("plumbline")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    more = {name.replace("_", "."): value for name, value in settings.items()}
    for name, value in (RUNTIME_SETTINGS | more).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the session's ``spark.checkpoint.dir``.

    Only a single-machine session that names none gets a temporary one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="plumbline-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For a table that a plan reads several times: it is computed once, a lost
    executor does not lose it, and later reads fetch only the columns they need.
    """
    path = f"{shared_folder(df.sparkSession)}/plumbline/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
