"""Spark session helpers.

The library never hard-codes cluster settings: on a cluster the session is
created by the platform and ``spark.checkpoint.dir`` names the shared folder
for lineage cuts.  ``local_session`` is for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "16g", app: str = "parley") -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    b = (b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
          .config("spark.driver.memory", driver_memory))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it.  Only a ``local`` master (tests) may leave it unset and
    gets a private scratch folder; elsewhere that raises, as executors don't
    share local folders.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
        d = tempfile.mkdtemp(prefix="parley-ckpt-", dir=os.environ.get("PARLEY_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df):
    """Materialise ``df`` to the shared checkpoint folder (reliable, not local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``parley`` importable in Python workers (``SparkContext.addPyFile``).

    Operators that run Python on executors (``mapInPandas``, the UDTF) pickle
    references to package functions; a zip of the package is added once per
    SparkContext (what ``--py-files`` does at submit time).
    """
    import shutil
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="parley-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "parley"), "zip", os.path.dirname(pkg), "parley")
    sc.addPyFile(archive)
    _SHIPPED.add(key)
