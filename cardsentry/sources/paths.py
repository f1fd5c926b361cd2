"""Whether folders exist, asked of the file system itself.

A reader that has nothing to read yet is told apart from one that fails: a
permission, schema or transient error is raised, never taken for "empty".
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return bool(fs.exists(p))


def glob_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches the glob."""
    p, fs = _path(spark, pattern)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def make_folder(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.mkdirs(p)


def write_once(spark: SparkSession, path: str, text: str) -> str:
    """Create ``path`` with ``text`` unless it exists; return what it holds."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        out = fs.create(p, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
    return "\n".join(r[0] for r in spark.read.text(path).collect())      # one short line


def partition_specs(spark: SparkSession, base: str, folder: str, columns: list[str]) -> list[str]:
    """Partition specifications (``a=1, b='x'``) of the leaf folders below ``folder``."""
    p, fs = _path(spark, f"{base}/{folder}" + "/*" * (len(columns) - 1))
    out = []
    for status in fs.globStatus(p) or []:
        names = str(status.getPath().toString()).split("/")[-len(columns):]
        if status.isDirectory() and all("=" in n for n in names):
            pairs = [n.split("=", 1) for n in names]
            out.append(", ".join(f"{k}=" + ("NULL" if v == "__HIVE_DEFAULT_PARTITION__" else f"'{v}'") for k, v in pairs))
    return out


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none when it does not exist."""
    p, fs = _path(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(str(status.getPath().getName()) for status in fs.listStatus(p))


def read_small(spark: SparkSession, path: str) -> str:
    """Text of a small file."""
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole or not at all; refuses to replace one."""
    p, fs = _path(spark, path)
    temporary = _path(spark, f"{p.getParent()}/_temporary-{p.getName()}")[0]
    if fs.exists(p):
        raise FileExistsError(f"{path} is already published")
    out = fs.create(temporary, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(temporary, p):
        raise FileExistsError(f"{path} could not be published")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file of this library; nothing happens when it is gone already."""
    p, fs = _path(spark, path)
    fs.delete(p, True)


def folder_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes and data files below a folder (names that begin with ``_`` or ``.`` left out)."""
    p, fs = _path(spark, path)
    total, files = 0, 0
    if fs.exists(p):
        found = fs.listFiles(p, True)
        while found.hasNext():
            status = found.next()
            if str(status.getPath().getName())[0] not in "_.":
                total, files = total + status.getLen(), files + 1
    return total, files
