"""File operations on the file system of a path (any scheme Spark can reach)."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The few operations that publishing and compaction need."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.fs = self.path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def names(self, p: str) -> list[str]:
        return sorted(st.getPath().getName() for st in self.fs.listStatus(self.path(p))) if self.fs.exists(self.path(p)) else []

    def size(self, p: str) -> int:
        return self.fs.getContentSummary(self.path(p)).getLength()

    def delete(self, p: str) -> None:
        self.fs.delete(self.path(p), True)

    def rename(self, a: str, b: str) -> None:
        self.fs.mkdirs(self.path(b).getParent())
        if not self.fs.rename(self.path(a), self.path(b)):
            raise OSError(f"cannot rename {a} to {b}")

    def write(self, p: str, text: str) -> None:
        """Create a file; an error if it exists."""
        out = self.fs.create(self.path(p), False)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, p: str) -> str:
        stream = self.fs.open(self.path(p))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
