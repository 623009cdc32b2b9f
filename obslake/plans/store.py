"""Small files in the lake's folder, through the file system that Spark has for it."""

from __future__ import annotations

import uuid
from contextlib import suppress
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Store:
    """A folder of small text files. Names may hold slashes."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm: Any = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self.folder = folder.rstrip("/")
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str) -> Any:
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def make(self) -> None:
        self._fs.mkdirs(self._path(""))

    def listed(self, name: str = "") -> dict[str, int]:
        """Names in a folder and when they were last written; none if there is no folder."""
        try:
            found = self._fs.listStatus(self._path(name))
        except Py4JJavaError as error:
            if _is(error, "FileNotFoundException"):
                return {}
            raise
        return {status.getPath().getName(): status.getModificationTime() for status in found}

    def read(self, name: str) -> str | None:
        """A file's text, or None if it is gone."""
        try:
            stream = self._fs.open(self._path(name))
        except Py4JJavaError as error:
            if _is(error, "FileNotFoundException"):
                return None
            raise
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def written_ms(self, name: str) -> int | None:
        try:
            return self._fs.getFileStatus(self._path(name)).getModificationTime()
        except Py4JJavaError as error:
            if _is(error, "FileNotFoundException"):
                return None
            raise

    def write(self, name: str, text: str = "") -> None:
        """Write a file, over an earlier one."""
        stream = self._fs.create(self._path(name), True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> bool:
        """Write a file that must not exist, whole or not at all; False if it does exist.

        The text is written under another name and then given its own in one step that fails
        if that is taken. A rename does that on HDFS; on a local disk, where a rename may go
        over what is there, a hard link does.
        """
        draft = f"_draft-{uuid.uuid4().hex}"
        self.write(draft, text)
        try:
            if self._fs.getScheme() == "file":
                self._fs.mkdirs(self._path(name).getParent())
                as_path = lambda path: self._jvm.java.io.File(path.toUri().getPath()).toPath()
                self._jvm.java.nio.file.Files.createLink(
                    as_path(self._fs.makeQualified(self._path(name))),
                    as_path(self._fs.makeQualified(self._path(draft))),
                )
            else:
                self._rename_new(draft, name)
            return True
        except Py4JJavaError as error:
            if _is(error, "FileAlreadyExistsException"):
                return False
            raise
        finally:
            self.remove(draft)

    def _rename_new(self, draft: str, name: str) -> None:
        kind = getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename")
        options = self._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs.getUri(), self._conf
        )
        self._fs.mkdirs(self._path(name).getParent())
        qualified = self._fs.makeQualified
        context.rename(qualified(self._path(draft)), qualified(self._path(name)), options)

    def remove(self, name: str) -> None:
        """Delete a file or a folder with all it holds; it may be gone."""
        with suppress(Py4JJavaError):
            self._fs.delete(self._path(name), True)


def _is(error: Py4JJavaError, name: str) -> bool:
    return error.java_exception.getClass().getSimpleName() == name
