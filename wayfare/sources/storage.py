"""The few file-system calls needed beside reads and writes of frames."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Storage:
    """File names only, on any file system Hadoop knows; no data passes here."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        handle = self._jvm.org.apache.hadoop.fs.Path(path)
        return handle.getFileSystem(self._conf), handle

    def exists(self, path: str) -> bool:
        fs, handle = self._at(path)
        return fs.exists(handle)

    def folders(self, path: str) -> list[str]:
        """Names of the folders directly below a path; none if it is absent."""
        fs, handle = self._at(path)
        if not fs.exists(handle):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(handle) if s.isDirectory())

    def files(self, path: str) -> list[str]:
        """Names of the files directly below a path; none if it is absent."""
        fs, handle = self._at(path)
        if not fs.exists(handle):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(handle) if s.isFile())

    def read(self, path: str) -> str:
        """A small text file."""
        fs, handle = self._at(path)
        stream = fs.open(handle)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """A small text file that isn't there yet."""
        fs, handle = self._at(path)
        stream = fs.create(handle, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def make(self, path: str) -> None:
        fs, handle = self._at(path)
        fs.mkdirs(handle)

    def delete(self, path: str) -> None:
        fs, handle = self._at(path)
        fs.delete(handle, True)

    def rename(self, source: str, target: str) -> None:
        fs, handle = self._at(source)
        destination = self._jvm.org.apache.hadoop.fs.Path(target)
        if fs.exists(destination):
            raise OSError(f"{target} is there already")
        fs.mkdirs(destination.getParent())
        if not fs.rename(handle, destination):
            raise OSError(f"cannot rename {source} to {target}")
