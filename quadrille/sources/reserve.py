"""Ranges of numbers that belong to one writer alone, reserved in the folder of a table.

A reservation is a file ``<k>`` with the first number of the range and of the next one. It appears whole and under a name that nobody else
has, or not at all; a writer that comes second finds the file there, reads it and tries the next name. Readers of tables skip the folder.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


def reserve(spark: SparkSession, folder: str, count: int, start: Callable[[], int]) -> int:
    """First of ``count`` neighbouring numbers that no other caller gets for this folder.

    ``start`` says where numbers begin while there is no reservation. Ranges follow one another without gaps; a writer that
    reserves and then fails leaves its numbers unused. Files whose successor is known are only history and may be deleted, the last one not.
    """
    if count < 1:
        raise ValueError("count must be positive")
    last = _last(spark, folder)
    while True:
        k, first = (0, start()) if last is None else (last[0] + 1, last[1])
        if _put_if_absent(spark, folder, f"{k:012d}", f"{first} {first + count}"):
            return first
        last = _last(spark, folder)


def reserved_until(spark: SparkSession, folder: str) -> int | None:
    """First number that is not reserved yet; None without reservations."""
    last = _last(spark, folder)
    return None if last is None else last[1]


def _local(folder: str) -> str | None:
    parts = urlparse(folder)
    return unquote(parts.path) if parts.scheme == "file" else folder if not parts.scheme else None


def _store(spark: SparkSession, folder: str):
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _on_disk(spark: SparkSession, folder: str) -> str | None:
    """The folder as a local path where it is on a file system of this machine."""
    default = spark._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(spark._jsc.hadoopConfiguration()).getScheme()
    return None if "://" not in folder and not folder.startswith("file:") and default != "file" else _local(folder)


def _last(spark: SparkSession, folder: str) -> tuple[int, int] | None:
    """Number of the last reservation and the number after its range."""
    path, store = spark._jvm.org.apache.hadoop.fs.Path, _store(spark, folder)
    if not store.exists(path(folder)):
        return None
    names = [s.getPath().getName() for s in store.listStatus(path(folder))]
    names = [n for n in names if n.isdigit()]
    if not names:
        return None
    stream = store.open(path(f"{folder}/{max(names)}"))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return int(max(names)), int(text.split()[1])


def _put_if_absent(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    here = _on_disk(spark, folder)
    return _link(here, name, text) if here is not None else _rename(spark, folder, name, text)


def _link(folder: str, name: str, text: str) -> bool:
    """On a local disk: a hard link is made by one call, which fails where the name exists."""
    os.makedirs(folder, exist_ok=True)
    draft = f"{folder}/.{uuid.uuid4().hex}"
    with open(draft, "x") as out:
        out.write(text)
    try:
        os.link(draft, f"{folder}/{name}")
        return True
    except FileExistsError:
        return False
    finally:
        os.unlink(draft)


def _rename(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """In a store: a rename that does not overwrite, which the store does in one step."""
    from py4j.protocol import Py4JJavaError

    hadoop, store = spark._jvm.org.apache.hadoop.fs, _store(spark, folder)
    draft, target = hadoop.Path(f"{folder}/.{uuid.uuid4().hex}"), store.makeQualified(hadoop.Path(f"{folder}/{name}"))
    store.mkdirs(hadoop.Path(folder))
    out = store.create(draft, False)
    try:
        out.write(text.encode())
    finally:
        out.close()
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = getattr(hadoop, "Options$Rename").NONE
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(store.makeQualified(draft), target, options)
        return True
    except Py4JJavaError as problem:
        if "FileAlreadyExistsException" not in problem.java_exception.getClass().getName():
            raise
        store.delete(draft, False)
        return False
