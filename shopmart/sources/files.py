"""Small files and folders of any store Spark can reach, handled from the driver.

For names, manifests and clean-up only; data is read and written by Spark itself.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A folder of the store its address belongs to."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self._store = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str = "") -> list[str]:
        """What lies in a folder, in order; nothing if it is not there."""
        path = self._path(name)
        if not self._store.exists(path):
            return []
        return sorted(found.getPath().getName() for found in self._store.listStatus(path))

    def size(self, name: str) -> int:
        """Bytes of a file or of all files in a folder; 0 if it is not there."""
        path = self._path(name)
        return self._store.getContentSummary(path).getLength() if self._store.exists(path) else 0

    def read(self, name: str) -> str:
        stream = self._store.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a file whole, unless one of that name is there: then False.

        It is written under another name first, so readers never see a part of it.
        """
        final, draft = self._path(name), self._path(f"{name}.{uuid.uuid4().hex}.draft")
        out = self._store.create(draft, False)
        out.write(text.encode())
        out.close()
        no_options = self._jvm.java.lang.reflect.Array.newInstance(
            self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0
        )
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf)
        try:
            context.rename(draft, final, no_options)
        except Py4JJavaError as error:
            self._store.delete(draft, False)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def remove(self, name: str = "") -> None:
        """A file, or a folder with all that is in it."""
        self._store.delete(self._path(name), True)
