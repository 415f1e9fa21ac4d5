"""Intermediate tables in the shared folder the cluster names.

A staged table cuts the lineage, survives lost executors, and gives Spark real
file sizes: a join against it is a broadcast join only if the table is in fact
below ``spark.sql.autoBroadcastJoinThreshold``, and a sort-merge join otherwise.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def staging_root(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a local session may fall back to a
    temporary folder of this machine, which then is its checkpoint folder."""
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="siltgate-"))
    return context.getCheckpointDir()


class Staging:
    """Staged tables of one run; leaving the ``with`` block removes them."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._folders: list[str] = []
        self._databases: list[str] = []
        # Held here because a stopped session no longer hands it out.
        self._files = spark._jvm.org.apache.hadoop.fs
        self._settings = spark._jsc.hadoopConfiguration()

    @classmethod
    def until_exit(cls, spark: SparkSession) -> Staging:
        """For results that are still lazy when the caller gets them: the tables stay
        until the driver program ends."""
        staging = cls(spark)
        atexit.register(staging._clear_at_exit)
        return staging

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *exc_info: object) -> None:
        self.clear()

    def folder(self, label: str) -> str:
        """A path below the staging root that no other run uses."""
        path = f"{staging_root(self._spark)}/siltgate/{label}-{uuid.uuid4().hex}"
        self._folders.append(path)
        return path

    def table(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` to a fresh folder and return the stored table."""
        path = self.folder(label)
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def database(self, label: str) -> str:
        """A database of the session catalog whose tables are stored in such a folder."""
        name = f"siltgate_{label}_{uuid.uuid4().hex}"
        self._spark.sql(f"CREATE DATABASE {name} LOCATION '{self.folder(label)}'")
        self._databases.append(name)
        return name

    def _clear_at_exit(self) -> None:
        try:
            self.clear()
        except (Py4JError, OSError):
            pass  # the JVM is gone already; the folder's retention rule takes over

    def clear(self) -> None:
        while self._databases:
            self._spark.sql(f"DROP DATABASE IF EXISTS {self._databases.pop()} CASCADE")
        while self._folders:
            path = self._files.Path(self._folders.pop())
            path.getFileSystem(self._settings).delete(path, True)
