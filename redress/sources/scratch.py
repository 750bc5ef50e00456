"""Where intermediate tables go: the shared folder the cluster names.

Tables that are stored on the way belong to the application and are deleted when it
ends; within ``scratch_tables`` they are deleted when the block ends.
"""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A local master may run without the setting and then gets a folder of its
    own; on a cluster a machine-local folder would be lost with its machine, so
    the missing setting is an error there. The folder becomes the session's
    checkpoint folder if it has none.
    """
    context = spark.sparkContext
    folder = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="redress-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_open: list[list[str]] = []


def _hadoop(spark: SparkSession, path: str):
    """File system and path object for ``path``, wherever it lies."""
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), own


def new_folder(spark: SparkSession, label: str, outlives: int = 0) -> str:
    """A path below the shared folder of this application that nothing else uses.

    It belongs to the innermost block of ``scratch_tables``, or to the one around so many
    as it ``outlives``.
    """
    root = f"{shared_folder(spark).rstrip('/')}/redress/{spark.sparkContext.applicationId}"
    files, folder = _hadoop(spark, root)
    if not files.exists(folder):
        files.mkdirs(folder)
        files.deleteOnExit(folder)
    path = f"{root}/{label}-{uuid.uuid4().hex}"
    if len(_open) > outlives:
        _open[-1 - outlives].append(path)
    return path


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that are stored within the block when it ends.

    For steps that write their results elsewhere, or settle them with ``outlives``:
    nothing that leaves the block may still read the tables.
    """
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            files, folder = _hadoop(spark, path)
            files.delete(folder, True)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within the block Spark deletes the shuffle files of each query as the query ends."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def settle(
    df: DataFrame, label: str, compression: str | None = None, outlives: int = 0
) -> DataFrame:
    """Write ``df`` once below the shared folder and continue from the table.

    Cuts the lineage: later plans read the stored rows, a lost executor costs
    no recomputation, and the planner knows the real size. Copies of wide texts take
    less space with ``compression="zstd"``. The shuffle files of ``df`` go once it is stored.
    """
    path = new_folder(df.sparkSession, label, outlives)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table that ``settle`` returned, before its block or its application ends."""
    files = table.inputFiles()
    if files:
        folder, path = _hadoop(table.sparkSession, files[0].rpartition("/")[0])
        folder.delete(path, True)
