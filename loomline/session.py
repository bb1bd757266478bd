"""Session helpers: where shared intermediate data may live, and how workers get this package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent


def local_session(app: str = "loomline", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests, the benchmark and the command line."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LOOMLINE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder of the session's ``spark.checkpoint.dir``, which all executors share.

    Where none is named a temporary folder becomes the checkpoint folder, but only on one machine (tests): elsewhere it
    would be another folder on each, so that this is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or f"file://{tempfile.mkdtemp(prefix='loomline-checkpoint-')}")
    return sc.getCheckpointDir()


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path for new files below the shared folder; no other call gets the same one."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` as written to the shared checkpoint folder: computed once, safe when executors are lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remove_dir(spark: SparkSession, path: str) -> None:
    """Removes a folder of any file system that Spark knows; one that isn't there is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(*cuts: DataFrame) -> None:
    """Removes the files of results of ``cut`` that nothing reads any more."""
    for df in cuts:
        file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        if file.isDefined():
            remove_dir(df.sparkSession, file.get())


#: Arrow batches between the JVM and Python, where the session has Spark's defaults: a batch of long texts takes its
#: size several times over, in both processes and for each core.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "4096"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", str(8 << 20)),
}


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for each context, and bounds the session's Arrow batches."""
    sc = spark.sparkContext
    for key, (default, bound) in BATCHES.items():
        if spark.conf.get(key) == default:
            spark.conf.set(key, bound)
    if getattr(sc, "_loomline_shipped", False):
        return
    target = Path(tempfile.mkdtemp(prefix="loomline-")) / "loomline_package.zip"
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted(PACKAGE.rglob("*.py")):
            out.write(path, str(path.relative_to(PACKAGE.parent)))
    sc.addPyFile(str(target))
    sc._loomline_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
