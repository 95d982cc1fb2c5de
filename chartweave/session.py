"""Session helpers: table access and lineage cuts that survive lost executors."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The parquet table `name` under `root`."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    The cluster names it in spark.checkpoint.dir; only in local mode (tests, a laptop), where
    that is unset and no folder was set by hand, a temporary folder is used.
    """
    sc = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not named and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "chartweave-checkpoints"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of `df` in the shared folder; later reads don't recompute it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application (as --py-files would)."""
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_chartweave_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="chartweave-"), "chartweave.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(home):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("chartweave", os.path.relpath(full, home)))
    sc.addPyFile(path)
    sc._chartweave_shipped = True
