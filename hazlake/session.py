"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that change results (time zone) or the physical plan (AQE).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Wide projections otherwise become one method too large for the JVM to compile.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Staged tables are written and read once or twice. At its first level zstd costs what snappy does,
# and text takes about three quarters of the room.
STAGED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}

#: How many bytes of rows go to a Python worker in one batch.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def build_session(app: str = "hazlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_conf(spark: SparkSession) -> SparkSession:
    """Put the result-relevant settings on a session somebody else built."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder every executor can reach.

    The cluster names the parent in ``spark.checkpoint.dir``. Only a local
    session, where driver and executors are one machine, may fall back to /tmp;
    such a folder goes when the program ends.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if parent:
        return f"{parent.rstrip('/')}/hazlake-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="hazlake-", dir="/tmp")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        return folder
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage on reliable storage, so a lost executor costs a task retry and
    not the whole upstream plan, and lets one path be read and replaced safely.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    df.write.options(**STAGED).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, most_bytes: int) -> Iterator[None]:
    """What runs inside hands rows to Python workers in batches of about ``most_bytes`` at most."""
    before = spark.conf.get(ARROW_BYTES)
    spark.conf.set(ARROW_BYTES, str(most_bytes))
    try:
        yield
    finally:
        spark.conf.set(ARROW_BYTES, before)


class Scratch:
    """A shared folder for the staged tables of one job, removed when the job is done."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path, self.count = spark, shared_dir(spark), 0

    def stage(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.path}/{self.count}"
        df.write.options(**STAGED).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(jvm_path))
