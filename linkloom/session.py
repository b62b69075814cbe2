"""Session defaults for local runs; on a cluster the submitter's settings hold."""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def local_session(cores: int = 8, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("linkloom")
        .config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", str(cores)).config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Tables whose rows much is computed from.
LARGE = {"customer", "orders", "lineitem", "events", "documents"}


def spread(scan: DataFrame) -> DataFrame:
    """The rows of a scan, dealt out over all cores if the files have fewer parts than cores, as a small table of one row group has.

    A scan of more parts, such as any table of a cluster's size, stays as it is and shuffles nothing.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    scan = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(scan) if name in LARGE else scan


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each context, so that batch functions find it on any cluster."""
    context = spark.sparkContext
    if getattr(context, "_linkloom_shipped", False):
        return
    here = Path(__file__).resolve().parent
    path = Path(os.path.realpath(tempfile.mkdtemp(prefix="linkloom-"))) / "linkloom.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(here.rglob("*.py")):
            archive.write(file, f"linkloom/{file.relative_to(here)}")
    context.addPyFile(str(path))
    context._linkloom_shipped = True


def shipped(f):
    """The query f, preceded by ship()."""

    @wraps(f)
    def run(spark, sf_dir):
        ship(spark)
        return f(spark, sf_dir)

    return run
