"""Intermediate tables: written to the folder that all executors share, and read back."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Without that setting a cluster's tables go beside those of
    the warehouse, which is shared too; only a local session, as in tests, gets a folder of this machine, gone at exit."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.sparkContext.master.split("[")[0] == "local":
            folder = tempfile.mkdtemp(prefix="concordat-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        else:
            folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/concordat-work-{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str = "table") -> str:
    return f"{work_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back: a lost executor costs a reread, not a rerun."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(*makers: Callable[[], DataFrame]) -> list[DataFrame]:
    """What the makers return, in their order; their jobs run side by side, so that a small one leaves no cores idle."""
    with ThreadPoolExecutor(len(makers)) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(make)) for make in makers]]
