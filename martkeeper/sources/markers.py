"""Markers: small text files that one writer creates and nobody changes.

A marker is what makes written data count. It appears whole or not at all, and of several writers
that want the same name exactly one succeeds; the others learn that they came too late. The text is
written beside it first and moved into place by a rename that never replaces a file (a hard
link on a local disk). File systems whose rename isn't atomic need a table format instead.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Create the marker unless there is one. True for the writer that created it."""
    files, target = _files(spark, path)
    target = files.makeQualified(target)
    if files.exists(target):
        return False
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".draft-{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    stream.write(text.encode("utf-8"))
    stream.close()
    jvm = spark._jvm
    try:
        if target.toUri().getScheme() == "file":
            paths = jvm.java.nio.file.Paths
            nio = [paths.get(jvm.java.net.URI.create(f"file://{p.toUri().getRawPath()}")) for p in (target, draft)]
            jvm.java.nio.file.Files.createLink(*nio)
        else:
            rename = jvm.org.apache.hadoop.fs.Options.Rename
            options = spark.sparkContext._gateway.new_array(rename, 1)
            options[0] = rename.NONE
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                target.toUri(), spark._jsc.hadoopConfiguration()
            )
            context.rename(draft, target, options)
            return True
    except Py4JJavaError:
        if not files.exists(target):
            raise
        return False
    finally:
        files.delete(draft, False)
    return True


def read(spark: SparkSession, path: str) -> str | None:
    """The text of a marker, None if there is none."""
    files, target = _files(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names(spark: SparkSession, path: str) -> list[str] | None:
    """What a folder contains, by name; None if there is no such folder."""
    files, folder = _files(spark, path)
    if not files.exists(folder):
        return None
    return sorted(s.getPath().getName() for s in files.listStatus(folder))
