"""Session settings, and the tables a job stores to cut its lineage."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that hold at any size: AQE sizes the shuffles and splits skewed join partitions
# even where the next step is an aggregation on the same key.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(name: str, folder: str, cores: str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """Session for tests and the bench, storing tables in `folder`; a cluster job brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", folder)
        # Recording the Python call site of every expression costs more than building the plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named in spark.checkpoint.dir or by setCheckpointDir."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise ValueError("Set spark.checkpoint.dir to a folder shared by the whole cluster.")
    return configured


class Run:
    """The stored tables of one job, in a folder of its own under the shared folder.

        with Run(spark):
            result = daily_forecast.run(lines, calendar)
            daily_forecast.write(result, "output/daily")

    Inside, `keep` and `pin` store tables here. Closing deletes this run's tables and no others, so
    frames made inside are read before the end.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"

    def new_path(self) -> str:
        return f"{self.folder}/{uuid.uuid4().hex}"

    def store(self, frame: DataFrame) -> DataFrame:
        path = self.new_path()
        frame.write.parquet(path)
        return frame.sparkSession.read.schema(frame.schema).parquet(path)

    def close(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Run:
        _open.append(self)
        return self

    def __exit__(self, *_: object) -> None:
        _open.remove(self)
        self.close()


# The open runs, the innermost last, and per session the run of what is stored outside of any.
_open: list[Run] = []
_outside: dict[str, Run] = {}


def _current(spark: SparkSession) -> Run:
    key = spark._jsparkSession.sessionUUID()
    for run in reversed(_open):
        if run.spark._jsparkSession.sessionUUID() == key:
            return run
    if key not in _outside:
        run = _outside[key] = Run(spark)
        atexit.register(_closed_at_exit, run)
    return _outside[key]


def _closed_at_exit(run: Run) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone, and its files with it
        run.close()


def keep(frame: DataFrame) -> DataFrame:
    """Write a frame that several later steps read as a table of the open run, and read it back.

    The steps behind it are not run again, a later step reads only its columns, and nothing is lost
    with an executor. Outside of a run, tables stay until the program ends.
    """
    return _current(frame.sparkSession).store(frame)


def own_path(spark: SparkSession) -> str:
    """A new path in the open run's folder, deleted with it."""
    return _current(spark).new_path()


def pin(frame: DataFrame) -> DataFrame:
    """`keep` for a small frame, such as a table per station and day or a loop's state."""
    return keep(frame)
