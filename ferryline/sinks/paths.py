"""Small file-system steps through Hadoop's API, so they work on any storage Spark can use."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def _listed(self, path: str, directories: bool) -> list[str]:
        if not self.exists(path):
            return []
        found = self._fs.listStatus(self._path(path))
        return sorted(s.getPath().getName() for s in found if s.isDirectory() == directories)

    def directory_names(self, path: str) -> list[str]:
        return self._listed(path, True)

    def file_names(self, path: str) -> list[str]:
        return self._listed(path, False)

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def rename(self, source: str, target: str) -> None:
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not rename {source} to {target}")

    def write_text(self, path: str, text: str) -> None:
        """Write a small file that appears whole or not at all."""
        part = f"{path}.part"
        out = self._fs.create(self._path(part), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.rename(part, path)

    def partition(self, path: str, column: str, value: object) -> str:
        """The directory Spark uses for one partition value."""
        return f"{path}/{self._utils.getPartitionPathString(column, str(value))}"
