"""Session building and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .errors import TablescopeError

_HELD: list[tempfile.TemporaryDirectory] = []  # folders of local sessions


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Local session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(master)
        .appName("tablescope")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise TablescopeError("Set spark.checkpoint.dir to a folder shared by the cluster.")
        # a single machine: driver and tasks share its disk; removed when the process ends
        holder = tempfile.TemporaryDirectory(prefix="tablescope-", ignore_cleanup_errors=True)
        _HELD.append(holder)
        folder = holder.name
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


class Intermediates:
    """The tables written while it is entered, and their removal.

    Frames that read them are of no use after :meth:`close`.  Entered again,
    it holds what is written then as well.
    """

    def __init__(self) -> None:
        self.paths: list[tuple[SparkSession, str]] = []

    def __enter__(self) -> "Intermediates":
        _OPEN.append(self)
        return self

    def __exit__(self, *_) -> None:
        _OPEN.pop()

    def close(self) -> None:
        """Delete the files; what is gone already is no error."""
        for spark, path in self.paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        self.paths.clear()


_OPEN: list[Intermediates] = [Intermediates()]  # the first one lasts as long as the process


@atexit.register
def _leave() -> None:
    try:
        _OPEN[0].close()
    except Exception:  # the session ended first; its folder is then left to whoever set it
        pass


def cut_lineage(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back.

    Later jobs start from the files, also after the loss of an executor, and
    the planner sees their true size, so joins with small tables broadcast.
    The files last until their :class:`Intermediates` are closed, or the
    process ends.
    """
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    _OPEN[-1].paths.append((df.sparkSession, path))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
