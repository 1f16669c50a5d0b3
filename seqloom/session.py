"""Session settings and lineage cuts shared by all plans."""

from __future__ import annotations

import gc
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, name: str = "seqloom", **conf: str) -> SparkSession:
    """A local session with the settings the plans are written for."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {"spark.sql.shuffle.partitions": str(cores), "spark.driver.memory": "8g", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; filters and column lists reach the parquet scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, one for each application, that all executors share.

    Only a session on one machine that has none, as in tests, gets a temporary one.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="seqloom-"))
    return context._jsc.sc().getCheckpointDir().get()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through :func:`shared_folder`.

    Executors may be lost afterwards: the data is on the shared file system and not in
    their memory.
    """
    spark = df.sparkSession
    shared_folder(spark)
    cut = df.checkpoint()
    # A checkpointed frame still carries the size estimates of the plan behind it, which
    # multiply with every join of an iteration; a frame over its rows alone does not.
    rows = cut._jdf.queryExecution().toRdd()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, cut._jdf.schema(), False), spark)


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` as a table in :func:`shared_folder`, and the folder it is in, for :func:`discard`.

    It takes less disk than a checkpoint, and its columns can be read one by one.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/{uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder), folder


def discard(spark: SparkSession, *folders: str) -> None:
    """Delete tables of :func:`stored`; no frame over them may be read any more."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free(spark: SparkSession) -> None:
    """Give back the shuffle files of frames that are gone; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def parallelism(spark: SparkSession) -> int:
    """Shuffle width of the session, the unit in which explicit splits are made."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
