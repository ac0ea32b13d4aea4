"""Listing, sizing, deleting and naming paths on whatever file system Spark writes to."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a directory; none when it is absent."""
    fs, p = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def size_in_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _open(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; none where there is no such file."""
    fs, p = _open(spark, path)
    try:
        stream = fs.open(p)
    except Py4JJavaError as error:
        return _none_if_absent(error)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _none_if_absent(error: Py4JJavaError) -> None:
    if "FileNotFound" not in error.java_exception.getClass().getName():
        raise error


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless the path is taken; of several writers one succeeds.

    The text is written under another name first, so that a reader finds all of it or nothing.
    A local file then gets its name by a hard link, on other file systems by a rename that does
    not replace; both fail where the name is taken. An object store needs a connector whose
    rename does that too.
    """
    fs, target = _open(spark, path)
    jvm = spark._jvm
    draft = jvm.org.apache.hadoop.fs.Path(f"{target.getParent()}/.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if fs.getScheme() == "file":
            names = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, draft)]
            jvm.java.nio.file.Files.createLink(*names)
        else:
            _rename_once(spark, fs, draft, target)
    except Py4JJavaError as error:
        if "AlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(draft, False)
    return True


def _rename_once(spark: SparkSession, fs, draft, target) -> None:
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context.rename(draft, target, options)


def changed(spark: SparkSession, path: str) -> float | None:
    """Seconds since the epoch at which a path was last changed; none where it is gone."""
    fs, p = _open(spark, path)
    try:
        return fs.getFileStatus(p).getModificationTime() / 1000
    except Py4JJavaError as error:
        return _none_if_absent(error)


def parquet_bounds(spark: SparkSession, path: str, column: str) -> list[tuple[int, int]] | None:
    """Least and greatest value of a whole-number column in each row group that has one, from
    the file's footer; none where the footer does not tell."""
    parquet = spark._jvm.org.apache.parquet.hadoop
    _, p = _open(spark, path)
    source = parquet.util.HadoopInputFile.fromPath(p, spark._jsc.hadoopConfiguration())
    reader = parquet.ParquetFileReader.open(source)
    try:
        found = []
        for block in reader.getFooter().getBlocks():
            chunks = [c for c in block.getColumns() if c.getPath().toDotString() == column]
            if len(chunks) != 1:
                return None
            known = chunks[0].getStatistics()
            if known is None or not known.hasNonNullValue():
                if known is None or known.getNumNulls() != chunks[0].getValueCount():
                    return None
                continue  # the row group has no value, but nulls
            least, most = known.genericGetMin(), known.genericGetMax()
            plain = chunks[0].getPrimitiveType().getLogicalTypeAnnotation() is None
            if not plain or not isinstance(least, int):
                return None
            found.append((least, most))
        return found
    finally:
        reader.close()
