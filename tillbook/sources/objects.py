"""Small text objects that are created whole, and at most once.

On local and mounted file systems an object is written aside and linked to its name. Elsewhere Hadoop's file
systems do it: by a rename that does not replace on HDFS, and by a create that does not replace on object
stores, where an object appears when it is closed. S3A needs conditional writes for that (``fs.s3a.create.conditional.enabled``).
"""

from __future__ import annotations

import os
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class LocalObjects:
    """Objects in a folder of a local or mounted file system."""

    def __init__(self, folder: str) -> None:
        self.folder = re.sub("^file:/*", "/", folder)

    def _aside(self, text: str) -> str:
        os.makedirs(self.folder, exist_ok=True)
        aside = f"{self.folder}/.{uuid.uuid4().hex}"
        with open(aside, "w", encoding="utf-8") as file:
            file.write(text)
        return aside

    def create(self, name: str, text: str) -> bool:
        """Whether the object was created; False if there is one of this name, which stays as it is."""
        aside = self._aside(text)
        try:
            os.link(aside, f"{self.folder}/{name}")
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(aside)

    def replace(self, name: str, text: str) -> None:
        os.replace(self._aside(text), f"{self.folder}/{name}")

    def read(self, name: str) -> str | None:
        """The text of the object, or None without one."""
        try:
            with open(f"{self.folder}/{name}", encoding="utf-8") as file:
                return file.read()
        except FileNotFoundError:
            return None


class HadoopObjects:
    """Objects in a folder of any file system that Spark's driver reaches."""

    _RENAMING = ("hdfs", "viewfs")

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.folder, self._jvm = folder.rstrip("/"), spark._jvm
        base = self._path("")
        self._files = base.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _write(self, path, text: str, replace: bool) -> None:
        stream = self._files.create(path, replace)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        target = self._path(name)
        if self._files.getScheme() in self._RENAMING:
            aside = self._path(f".{uuid.uuid4().hex}")
            self._write(aside, text, False)
            done = self._files.rename(aside, target)
            if not done:
                self._files.delete(aside, False)
            return done
        try:
            self._write(target, text, False)
            return True
        except Py4JJavaError as problem:
            name = problem.java_exception.getClass().getSimpleName()
            if name != "FileAlreadyExistsException" and "412" not in str(problem.java_exception.getMessage()):
                raise
            return False

    def replace(self, name: str, text: str) -> None:
        self._write(self._path(name), text, True)

    def read(self, name: str) -> str | None:
        try:
            stream = self._files.open(self._path(name))
        except Py4JJavaError as problem:
            if problem.java_exception.getClass().getSimpleName() != "FileNotFoundException":
                raise
            return None
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def objects(spark: SparkSession, folder: str) -> LocalObjects | HadoopObjects:
    """The objects of a folder, by the scheme of its path."""
    local = "://" not in folder or folder.startswith("file:")
    return LocalObjects(folder) if local and not folder.startswith("viewfs:") else HadoopObjects(spark, folder)
