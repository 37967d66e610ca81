"""Session, table access and lineage cutting shared by all operators."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster the caller brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("rollcall")
    base = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("ROLLCALL_DRIVER_MEMORY", "8g"),
    }
    for k, v in {**base, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Write ``df`` to the checkpoint folder and read it back, so lost executors cost no recomputation.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; only a local session without one (tests, a
    laptop) gets a temporary folder, which is deleted at exit. A cluster without one is an error.
    """
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=eager)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for what is written and read again; set as the session's checkpoint folder if none is."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            named = tempfile.mkdtemp(prefix="rollcall-checkpoint-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
    return sc._jsc.sc().getCheckpointDir().get()
