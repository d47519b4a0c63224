"""Session helpers: a local session for tests, table reading, and lineage cutting."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and benches; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lexquarry")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("LEXQUARRY_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A scan with fewer partitions than the session has cores, spread over all cores; any other one as it is.

    A small file is one split however much work a row makes; the files of a large table are enough splits.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


#: Partitions for each core where the work is dealt by key, so that no core waits long for the last one.
PER_CORE = 4


def deal(df: DataFrame, key: str) -> DataFrame:
    """A narrow scan dealt by its key, for rows that cost far more than their bytes: a file may be one row group, which no split divides."""
    return df.repartition(max(df.rdd.getNumPartitions(), PER_CORE * df.sparkSession.sparkContext.defaultParallelism), key)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint.

    The folder is the one that ``spark.checkpoint.dir`` names, which all executors share, so the
    result survives the loss of any executor. Where the setting is missing, a local session gets a folder
    of its own, which goes when the process ends; on a cluster that is an error, as executors could not share it.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not named and not re.match(r"local($|\[)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not named:
            named = tempfile.mkdtemp(prefix="lexquarry-checkpoint-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
    return df.checkpoint(eager=True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package to the executors, once per application, so that it need not be installed there."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    home = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="lexquarry-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/lexquarry.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(home.rglob("*.py")):
            z.write(f, f.relative_to(home.parent))
    sc.addPyFile(f"{folder}/lexquarry.zip")
