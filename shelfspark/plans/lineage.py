"""Cutting lineage with tables in the folder that all executors share.

The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a
local session without that setting gets a folder of its own (tests, a laptop);
on a cluster a missing setting is an error, because a machine-local folder
would be lost with its executor.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_RUN = f"shelfspark-{uuid.uuid4().hex}"
_MADE: set[str] = set()
#: Rows that one task groups, about.
ROWS_A_TASK = 1 << 17
#: Paths of cut tables, by the DataFrame that reads them.
_PATHS: dict[int, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of this session, as a URI or path that Spark can write to."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="shelfspark-checkpoints-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; removed when the driver ends."""
    top = f"{shared_folder(spark)}/{_RUN}"
    if top not in _MADE:
        _MADE.add(top)
        atexit.register(_remove, spark, top)
    return f"{top}/{name}-{uuid.uuid4().hex[:12]}"


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session is gone already; the folder's own clean-up rule takes over
        pass


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Later stages read the table instead of recomputing what led to it, and a
    lost executor costs only its own tasks. The scan also gives the optimizer
    true sizes, so small results are broadcast by Spark's own threshold.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[id(out)] = path
    weakref.finalize(out, _PATHS.pop, id(out), None)
    return out


def spread(df: DataFrame, key: str, rows: int) -> DataFrame:
    """``df`` dealt out by ``key`` over so many tasks that each gets about ROWS_A_TASK of ``rows``; few rows stay as they are.

    What a task sorts or groups then does not grow with the input, whatever the
    session's number of shuffle partitions is.
    """
    tasks = -(-rows // ROWS_A_TASK)
    return df.repartition(tasks, key) if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def drop(df: DataFrame) -> None:
    """Remove the table of a ``cut`` that nothing reads any more; any other DataFrame is left alone."""
    if path := _PATHS.pop(id(df), None):
        _remove(df.sparkSession, path)
