"""Session settings and the shared folder in which jobs keep intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
_CLEANUP = [f"spark.sql.{kind}.shuffleDependency.fileCleanup.enabled" for kind in ("classic", "connect")]


def local_session(cores: str = "*", app: str = "pagequarry", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="pagequarry-")
    return _LOCAL_DIRS[app]


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Inside, these settings hold; afterwards the session's own do again."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def lean(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, what a job shuffled is deleted as soon as the job has ended.

    Otherwise shuffle files stay until the driver happens to collect its garbage, so that a flow of
    many jobs holds those of all of them.
    """
    return settings(spark, dict.fromkeys(_CLEANUP, "true"))


class Workspace:
    """A fresh folder of Parquet tables inside the shared folder.

    Writing a table and reading it back cuts the lineage, survives the loss of
    any executor, and gives the optimizer real sizes for the next join.
    """

    def __init__(self, spark: SparkSession, name: str = "job", root: str | None = None):
        """``root`` is a folder of the caller's choice, for a job that may go on later."""
        self.spark = spark
        self.root = root or f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def save(self, df: DataFrame, table: str) -> DataFrame:
        """Write (replacing an older copy) and return the stored table."""
        with lean(self.spark):
            df.write.mode("overwrite").parquet(self.path(table))
        return self.spark.read.schema(df.schema).parquet(self.path(table))

    def close(self) -> None:
        """Delete all tables; frames that read them can no longer be used."""
        empty_folder(self.spark, self.root)

    def __enter__(self) -> "Workspace":
        return self

    def __exit__(self, *error) -> None:
        self.close()


def empty_folder(spark: SparkSession, path: str) -> None:
    """Delete everything below a folder, by writing no rows over it; works on any storage Spark writes to."""
    # a partitioned write leaves no file where there are no rows
    nothing = spark.range(0).selectExpr("id", "id AS part").write.mode("overwrite")
    nothing.option("partitionOverwriteMode", "static").partitionBy("part").parquet(path)


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None if nothing is stored there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
