"""Committed versions: numbered files in a folder, each made once and never changed."""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has committed the version first."""


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in any file system that Spark reads; none if there is no folder."""
    place, system = _place(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def files_below(spark: SparkSession, path: str) -> set[str]:
    """Paths of all files below a folder, as the file system names them; none if there is no folder."""
    place, system = _place(spark, path)
    if not system.exists(place):
        return set()
    listed, found = system.listFiles(place, True), set()
    while listed.hasNext():
        found.add(listed.next().getPath().toString())
    return found


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file if it is there."""
    place, system = _place(spark, path)
    system.delete(place, True)


def read(spark: SparkSession, root: str, number: int) -> str:
    """Content of one version."""
    place, system = _place(spark, f"{root}/{number:012d}")
    stream = system.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def newest(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """Number and content of the newest version; none if there is none."""
    numbers = [int(n) for n in child_names(spark, root) if n.isdigit()]
    return (max(numbers), read(spark, root, max(numbers))) if numbers else None


def commit(spark: SparkSession, root: str, after: int, content: str) -> int:
    """Make the version that follows ``after`` (0 for the first); raises ``Conflict`` where it is there already.

    The content is written whole under a name of its own, which then becomes the version's name unless that is
    taken: of several writers one succeeds, and no reader meets half a file.
    """
    number = after + 1
    target, temporary = f"{root}/{number:012d}", f"{root}/.{uuid.uuid4().hex}"
    place, system = _place(spark, temporary)
    stream = system.create(place, False)
    stream.write(content.encode())
    stream.close()
    try:
        if system.getScheme() == "file":
            # The local file system renames over what is there; a link does not.
            os.link(urlparse(temporary).path, urlparse(target).path)
        else:
            jvm = spark.sparkContext._jvm
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(place, _place(spark, target)[0], none)
    except FileExistsError as error:
        raise Conflict(target) from error
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception):
            raise Conflict(target) from error
        raise
    finally:
        system.delete(place, False)
    return number
