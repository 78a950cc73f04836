"""Session helpers: local sessions for tests, the shared folder, tables written there."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _memory_gb() -> int:
    """Memory of this machine."""
    return os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") >> 30


def local_session(cores: str | int = "*", app: str = "tokenloom") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", f"{max(2, _memory_gb() * 5 // 8)}g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests) may fall back to a fresh temporary folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current is None:
            if context.master.partition("[")[0] != "local":
                raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
            current = tempfile.mkdtemp(prefix="tokenloom-")
        context.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Tables written by this process; removed when their session ends.
_written: dict[str, SparkSession] = {}


def materialize(
    df: DataFrame, name: str = "table", options: dict[str, str] | None = None
) -> DataFrame:
    """Write once to the shared folder as parquet and read it back: lineage ends there.

    The files survive lost executors. They go with :func:`release`, or when the process
    ends while its session is still up.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**(options or {})).parquet(path)
    if not _written:
        atexit.register(_remove_all)
    _written[path] = spark
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Remove the files of materialized tables that nothing reads any more."""
    for table in tables:
        for path in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            for known in [x for x in _written if path.endswith(x.rsplit("/", 1)[-1])]:
                _remove(known, _written.pop(known))


def collect_garbage(spark: SparkSession) -> None:
    """Collect the driver's garbage: only then do the shuffle files of finished jobs go."""
    spark.sparkContext._jvm.System.gc()


def _remove(path: str, spark: SparkSession) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _remove_all() -> None:
    for path, spark in _written.items():
        try:
            _remove(path, spark)
        except Exception:  # the session has ended; its folder is the cluster's to clean
            break
