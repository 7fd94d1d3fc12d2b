"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings of a local session; a cluster's own settings stay as they are.
LOCAL = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = 8, memory: str = "8g", name: str = "lexharbor") -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name).config("spark.driver.memory", memory)
    spark = builder.config(map=LOCAL).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table `name` of the folder `sf_dir`."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir; only where that is unset and the session is of one machine, as in tests, one
    of our own. Raises RuntimeError on a cluster that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    own = os.path.join(tempfile.gettempdir(), f"lexharbor-{spark.sparkContext.applicationId}")
    return f"file://{own}"


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """`df` written to the shared folder and read again: what was computed is kept when executors are lost, and is computed once."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager)


def spread(scan: DataFrame) -> DataFrame:
    """A scan whose files give fewer tasks than there are cores, dealt out over all cores; any other scan as it is, without a shuffle."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def bounded(small: DataFrame, counted: DataFrame | None = None, most_rows: int = 10_000) -> DataFrame:
    """`small` marked for broadcast if it has no more than `most_rows` rows, else as it is, for the planner to join by shuffle.

    `counted`, if given, is a cheaper table that has at least as many rows.
    """
    n = len((small if counted is None else counted).select(F.lit(1)).limit(most_rows + 1).collect())
    return F.broadcast(small) if n <= most_rows else small


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, for clusters whose workers have it on no path of their own."""
    context = spark.sparkContext
    if getattr(context, "_lexharbor_sent", None) == context.applicationId:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="lexharbor-")  # of the driver; Spark's file server hands it on
    archive = shutil.make_archive(os.path.join(folder, "lexharbor"), "zip", package.parent, package.name)
    context.addPyFile(archive)
    context._lexharbor_sent = context.applicationId
