"""Session helpers: one place for the configuration the operators rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "alignfold", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and benches.

    On a cluster the session already exists (``spark-submit``) and its settings win;
    only unset keys get defaults here.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app).master(master or os.environ.get("ALIGNFOLD_MASTER", "local[8]"))
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions or 8),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # text stages are CPU-bound per row: do not let AQE coalesce a few MB of shuffle
        # output into a single task
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it; we only set our own when it is unset and everything runs in this process
    (local tests). On any other master a folder of this machine would not be shared: an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        d = tempfile.mkdtemp(prefix="alignfold-ckpt-", dir=os.environ.get("ALIGNFOLD_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``alignfold`` importable in Python workers (the programmatic form of ``--py-files``).

    Operators that run Python in tasks (Arrow block products, batch generation, pandas-UDF
    hooks) pickle references to this package; a zip of the package is registered once per
    application with ``SparkContext.addPyFile``, which Spark ships to every executor.
    """
    import shutil

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = tempfile.mkdtemp(prefix="alignfold-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "alignfold"), "zip", root_dir=pkg_root, base_dir="alignfold")
    sc.addPyFile(archive)
    _SHIPPED.add(key)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder; survives executor loss (never localCheckpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
