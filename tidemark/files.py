"""Small control files, through the cluster's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """Create-once files, atomic replacement and listings on any Hadoop path."""

    def __init__(self, spark: SparkSession):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Whether the file was created: written aside, then renamed to a name
        that must be free, so readers never see half a file."""
        fs, p = self._at(path)
        fs.mkdirs(p.getParent())
        if fs.exists(p):
            return False
        aside = self.jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{self.jvm.java.util.UUID.randomUUID().toString()}")
        out = fs.create(aside, False)
        try:
            out.write(bytearray(text.encode()))
            out.hsync()
        finally:
            out.close()
        if fs.exists(p) or not fs.rename(aside, p):
            fs.delete(aside, False)
            return False
        return True

    def replace(self, path: str, text: str) -> None:
        fs, p = self._at(path)
        if fs.exists(p):
            fs.delete(p, False)
        if not self.create(path, text):
            raise FileExistsError(path)

    def list(self, path: str) -> list[str]:
        fs, p = self._at(path)
        if not fs.exists(p):
            return []
        return sorted(x.getPath().toString() for x in fs.listStatus(p) if not x.getPath().getName().startswith("."))

    def size(self, path: str) -> int:
        """Bytes of a file or of all files below a folder."""
        fs, p = self._at(path)
        return fs.getContentSummary(p).getLength()

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)
