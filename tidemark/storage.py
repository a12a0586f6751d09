"""Small metadata files beside tables, through the file system that Spark resolves."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .session import hadoop_path


class Files:
    """The file-system calls of a table, through the file system that Spark resolves; counted."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.calls = spark, root, 0
        self.fs, self.path = hadoop_path(spark, root)

    def at(self, name: str):
        return self.path.suffix("/" + name)

    def names(self, folder: str) -> list[str]:
        self.calls += 1
        try:
            return [s.getPath().getName() for s in self.fs.listStatus(self.at(folder))]
        except Exception as e:  # noqa: BLE001  (py4j wraps the Java exception)
            if "FileNotFoundException" in str(e):
                return []
            raise

    def read(self, name: str) -> str:
        self.calls += 1
        stream = self.fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Under another name first: a reader sees the whole file or none."""
        self.calls += 3
        tmp = self.at(f"{name}.part")
        out = self.fs.create(tmp, True)
        out.write(bytearray(text.encode()))
        out.close()
        self.fs.delete(self.at(name), False)
        if not self.fs.rename(tmp, self.at(name)):
            raise RuntimeError(f"could not commit {self.root}/{name}")

    def delete(self, name: str) -> None:
        self.calls += 1
        self.fs.delete(self.at(name), True)

    def size(self, name: str) -> int:
        self.calls += 1
        return self.fs.getContentSummary(self.at(name)).getLength()
