"""Session helpers: table access and lineage cuts in the cluster's shared folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once a session, unless their Python finds it anyway: in a local session started in
    its folder or with it in PYTHONPATH, or where it is installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    paths = {os.path.abspath(p) for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p}
    if "site-packages" in root or (context.master.startswith("local") and root in paths):
        return
    folder = tempfile.mkdtemp(prefix="tessera-package-")  # on the driver, which serves it to the executors
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "tessera.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for at, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(at, name), os.path.relpath(os.path.join(at, name), root))
    context.addPyFile(archive)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``folder`` (one file or a folder of parts)."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset (local tests) a folder of this machine is set; a cluster must name its own,
    as a machine-local folder is not seen by other executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tessera-checkpoints-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder: later jobs read the files, executors may be lost."""
    ship(df.sparkSession)
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    ship(spark)
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
