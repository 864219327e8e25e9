"""Small steps on a folder of any file system that Spark can open."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._root = spark, path.rstrip("/")
        self._Path = spark._jvm.org.apache.hadoop.fs.Path
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._system = self._Path(self._root).getFileSystem(conf)

    def path(self, *parts: str) -> str:
        return "/".join([self._root, *parts])

    def _of(self, *parts: str):
        return self._Path(self.path(*parts))

    def names(self, part: str) -> list[str]:
        """Names in a subfolder, in order; none when it is missing."""
        folder = self._of(part)
        if not self._system.exists(folder):
            return []
        return sorted(found.getPath().getName() for found in self._system.listStatus(folder))

    def move(self, source: str, target: str):
        """Rename a folder; the target must not be there."""
        place = self._Path(target)
        self._system.mkdirs(place.getParent())
        if self._system.exists(place) or not self._system.rename(self._Path(source), place):
            raise RuntimeError(f"{source} cannot be moved to {target}")

    def delete(self, *parts: str):
        self._system.delete(self._of(*parts), True)

    def read_text(self, name: str) -> str | None:
        if not self._system.exists(self._of(name)):
            return None
        stream = self._system.open(self._of(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_text(self, name: str, text: str):
        stream = self._system.create(self._of(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
