"""Named collections under one base path, each a list of immutable snapshot folders.

A write goes to a folder of its own, and a small pointer file, replaced in one step when the write has succeeded, names
the folders that make up the collection. A reader therefore sees a collection before or after a write and never half of
it, a job that is lost leaves the old one, and a frame may replace or extend the collection it reads. Folders that no
pointer names any more stay until ``vacuum``, for readers that still use them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfsense.schemas import COLLECTION_SCHEMAS

#: Spark reads it as text, so its name must not mark it as hidden.
POINTER = "current.txt"


class Catalog:
    """Reads and writes collections; ``fmt`` is any file format Spark reads."""

    def __init__(self, spark: SparkSession, base: str, fmt: str = "parquet"):
        self.spark = spark
        self.base = base.rstrip("/")
        self.fmt = fmt

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def _hadoop(self, path: str):
        """(the path, its file system, as Hadoop sees them): any store Spark can write to."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        where = hadoop.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def snapshots(self, name: str) -> list[str]:
        """The folders that make up the collection just now; none before its first write."""
        pointer, store = self._hadoop(f"{self.path(name)}/{POINTER}")
        if not store.exists(pointer):
            return []
        return [row.value for row in self.spark.read.text(f"{self.path(name)}/{POINTER}").collect()]

    def _point(self, name: str, folders: list[str]) -> None:
        """Replace the pointer in one step."""
        pointer = f"{self.path(name)}/{POINTER}"
        draft, store = self._hadoop(f"{pointer}-{uuid.uuid4().hex}")
        out = store.create(draft)
        out.write(bytearray("".join(f"{folder}\n" for folder in folders).encode()))
        out.close()
        jvm = self.spark._jvm
        replace = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        replace[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(draft, jvm.org.apache.hadoop.fs.Path(pointer), replace)

    def _written(self, name: str, df: DataFrame) -> str:
        folder = f"snapshot-{uuid.uuid4().hex}"
        df.write.format(self.fmt).save(f"{self.path(name)}/{folder}")
        return folder

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """The collection under its declared schema: nothing is inferred from the files."""
        shape = schema or COLLECTION_SCHEMAS.get(name)
        reader = self.spark.read.format(self.fmt)
        paths = [f"{self.path(name)}/{folder}" for folder in self.snapshots(name)] or [self.path(name)]
        return (reader.schema(shape) if shape is not None else reader).load(paths)

    def overwrite(self, name: str, df: DataFrame) -> None:
        """Replace the collection, also by a frame that reads it."""
        self._point(name, [self._written(name, df)])

    def append(self, name: str, df: DataFrame) -> None:
        """Add a batch of rows. One writer at a time; readers may go on."""
        added = self._written(name, df)
        self._point(name, [*self.snapshots(name), added])

    def compact(self, name: str) -> None:
        """One snapshot in place of many."""
        self.overwrite(name, self.read(name))

    def vacuum(self, name: str) -> None:
        """Delete what no pointer names: replaced snapshots, and those of jobs that were lost."""
        current = {*self.snapshots(name), POINTER}
        where, store = self._hadoop(self.path(name))
        for found in store.listStatus(where):
            if found.getPath().getName() not in current:
                store.delete(found.getPath(), True)

    def view(self, name: str, view_name: str) -> DataFrame:
        df = self.read(name)
        df.createOrReplaceTempView(view_name)
        return df
