"""The few file operations that Spark's reader and writer do not cover, on any Hadoop file system."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm = spark._jvm
        self.root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def url(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._path(name))

    def names(self, name: str = "") -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(name))] if self.exists(name) else []

    def has(self, name: str, prefix: str) -> bool:
        """Whether a folder has an entry with this prefix; looks at no more entries than it takes."""
        if not self.exists(name):
            return False
        entries = self._fs.listStatusIterator(self._path(name))
        while entries.hasNext():
            if entries.next().getPath().getName().startswith(prefix):
                return True
        return False

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._path(name), True)

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish_text(self, name: str, text: str) -> bool:
        """Write a file under its final name in one step; false if somebody else published that name first."""
        draft = self._path(f"{name}.draft-{self._jvm.java.util.UUID.randomUUID().toString()}")
        stream = self._fs.create(draft, True)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        if self.exists(name) or not self._fs.rename(draft, self._path(name)):
            self._fs.delete(draft, False)
            return False
        return True


def scratch_folder(spark: SparkSession, name: str) -> str:
    """The name of a new folder for written intermediate tables that all executors see.

    It lies in `spark.checkpoint.dir`, else in the context's checkpoint folder, else beside the warehouse's tables. Only a
    local master, where there is one machine, gets a temporary folder where none of these is set.
    """
    name = f"{name}-{uuid.uuid4().hex}"
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        folder = spark.sparkContext._jsc.sc().getCheckpointDir()
        shared = folder.get() if folder.isDefined() else None
    if not shared and not re.match(r"local(\[|$)", spark.sparkContext.master):
        shared = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    if not shared:
        return tempfile.mkdtemp(prefix=f"{name}-")
    return f"{shared.rstrip('/')}/{name}"
