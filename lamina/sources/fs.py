"""Small driver-side filesystem calls through the session's Hadoop FileSystem.

Only metadata goes through here (existence, sizes, listings, a pointer file of a
few bytes); data always moves in Spark jobs. Works for any Hadoop-compatible
store the cluster names (HDFS, object stores, local files in tests).
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def total_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return 0
    return int(fs.getContentSummary(p).getLength())


def count_paths(spark: SparkSession, pattern: str) -> int:
    """How many paths match a glob pattern (e.g. the data files of folders); the names
    stay in the JVM."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    return 0 if found is None else len(found)


def glob_dirs(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob pattern (e.g. partition folders)."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    return [] if found is None else [str(st.getPath()) for st in found]


def names(spark: SparkSession, pattern: str) -> list[str]:
    """Last parts of the paths that match a glob pattern."""
    return [d.rstrip("/").rsplit("/", 1)[1] for d in glob_dirs(spark, pattern)]


def lines(spark: SparkSession, path: str) -> list[str]:
    """The lines of a small text file; none without the file."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    out = []
    try:
        while (line := reader.readLine()) is not None:
            out.append(str(line))
    finally:
        reader.close()
    return out


def remove_file(spark: SparkSession, uri: str, into: str | None = None) -> bool:
    """Delete one file, given by its (encoded) URI, or move it to the same path below
    ``into``. False if it isn't there any more."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return False
    if into is None:
        return bool(fs.delete(p, False))
    to = jvm.org.apache.hadoop.fs.Path(into + str(p.toUri().getPath()))
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"{uri} could not be moved below {into}")
    return True


def copy_beginning(spark: SparkSession, path: str, to: str, part: float = 0.5) -> None:
    """A new file with the first ``part`` of a small file's bytes (to see how damaged files are
    read)."""
    fs, p = _fs(spark, path)
    source = fs.open(p)
    out = fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to), True)
    try:
        out.write(bytearray(source.readNBytes(int(fs.getFileStatus(p).getLen() * part))))
    finally:
        out.close()
        source.close()


def _numbered(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """The versions of a small text file, the newest first."""
    found = ((d.rsplit(".", 1)[1], d) for d in glob_dirs(spark, f"{path}.[0-9]*"))
    return sorted(((int(n), d) for n, d in found if n.isdigit()), reverse=True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small text file in one step: a new version ``<path>.<n>`` appears by one
    rename to a name that did not exist, which no file system does by halves. Readers
    take the largest number, so they find the old contents or the new. The version
    before is kept for readers that have just listed it. One writer at a time."""
    fs, _ = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    versions = _numbered(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    number = versions[0][0] + 1 if versions else 0
    if not fs.rename(tmp, jvm.org.apache.hadoop.fs.Path(f"{path}.{number}")):
        raise OSError(f"{path}.{number} could not be written")
    for _, old in versions[1:]:
        delete(spark, old)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Contents of a small text file written by :func:`write_text`; None without one."""
    jvm = spark.sparkContext._jvm
    for _ in range(10):
        versions = _numbered(spark, path)
        if not versions:
            return None
        fs, p = _fs(spark, versions[0][1])
        try:
            stream = fs.open(p)
        except Py4JJavaError:  # replaced twice since it was listed
            if fs.exists(p):
                raise
            continue
        try:
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
            line = reader.readLine()
            return None if line is None else str(line)
        finally:
            stream.close()
    raise OSError(f"{path} is replaced faster than it can be read")
