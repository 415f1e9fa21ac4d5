"""Folders of layers: written beside each other, swapped and recovered."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# What an escaped CSV writes for a character, the sign of the codes first.
ESCAPES = (("%", "%25"), ("\\", "%5C"), ("\n", "%0A"), ("\r", "%0D"))


def is_catalog_of_its_own(spark: SparkSession, where: str) -> bool:
    """Whether a name is of three parts and not the session catalog's."""
    parts = where.split(".")
    return "/" not in where and len(parts) == 3 and parts[0] != "spark_catalog"


def table_folder(spark: SparkSession, table: str) -> str:
    """Where the session catalog would put a table."""
    *database, name = table.split(".")
    found = spark.catalog.getDatabase(database[-1] if database else spark.catalog.currentDatabase())
    return f"{found.locationUri.rstrip('/')}/{name}"


class Folders:
    """Folders on any file system that Spark writes to. Names that begin with an
    underscore are no data to its readers."""

    def __init__(self, spark: SparkSession) -> None:
        self._names = spark._jvm.org.apache.hadoop.fs
        self._settings = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        at = self._names.Path(path)
        return at.getFileSystem(self._settings), at

    @staticmethod
    def _sibling(where: str, kind: str) -> str:
        parent, _, name = where.rstrip("/").rpartition("/")
        return f"{parent}/_{name}.{kind}"

    def beside(self, where: str) -> str:
        """A new folder's name beside ``where``, on the same file system."""
        return self._sibling(where, f"new-{uuid.uuid4().hex}")

    def fresh(self, where: str) -> str:
        """A name for another version of ``where`` that readers take for data."""
        return f"{where}-{uuid.uuid4().hex}"

    def exists(self, path: str) -> bool:
        system, at = self._at(path)
        return system.exists(at)

    def make(self, path: str) -> None:
        system, at = self._at(path)
        system.mkdirs(at)

    def delete(self, path: str) -> None:
        system, at = self._at(path)
        system.delete(at, True)

    def move(self, path: str, to: str) -> None:
        system, at = self._at(path)
        if not system.rename(at, self._names.Path(to)):
            raise OSError(f"could not move {path} to {to}")

    def data_files(self, path: str) -> list[str]:
        system, at = self._at(path)
        found = [s.getPath() for s in system.listStatus(at)]
        return [p.toString() for p in found if not p.getName().startswith(("_", "."))]

    def swap(self, new: str, where: str) -> None:
        """Put ``new`` in the place of ``where``, whose old folder is deleted afterwards."""
        before = self._sibling(where, "before")
        self.recover(where)
        self.delete(before)
        if self.exists(where):
            self.move(where, before)
        try:
            self.move(new, where)
        except (OSError, Py4JJavaError):
            self.recover(where)
            raise
        self.delete(before)

    def recover(self, where: str) -> bool:
        """Put the old folder back if a swap was cut off between its two moves."""
        before = self._sibling(where, "before")
        if self.exists(where) or not self.exists(before):
            return False
        self.move(before, where)
        return True
