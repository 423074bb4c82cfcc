"""Directory-level operations on whatever file system a path names (metadata only)."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _open(spark, path)
    return fs.exists(jpath)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly below ``path``, sorted; empty if there is none."""
    fs, jpath = _open(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory())


def make_dir(spark: SparkSession, path: str) -> None:
    fs, jpath = _open(spark, path)
    fs.mkdirs(jpath)


def glob_sizes(spark: SparkSession, pattern: str) -> dict[str, int]:
    """Paths a glob matches, relative to its fixed part (before the first ``/*``), and their
    sizes, in order; one listing."""
    fs, jpath = _open(spark, pattern)
    depth = pattern[pattern.index("/*"):].count("/")
    found = {"/".join(s.getPath().toString().split("/")[-depth:]): s.getLen() for s in fs.globStatus(jpath) or []}
    return dict(sorted(found.items()))


def glob_files(spark: SparkSession, pattern: str) -> list[str]:
    """Files matching a glob, sorted by path; hidden and marker files are left out."""
    fs, jpath = _open(spark, pattern)
    found = []
    for status in fs.globStatus(jpath) or []:
        inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [
            s.getPath().toString()
            for s in inside
            if s.isFile() and not s.getPath().getName().startswith(("_", "."))
        ]
    return sorted(found)


def uri(spark: SparkSession, path: str) -> str:
    """The path as ``_metadata.file_path`` spells it."""
    return spark._jvm.org.apache.hadoop.fs.Path(path).toUri().toString()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole: written aside, then renamed."""
    fs, jpath = _open(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    out = fs.create(aside, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if not fs.rename(aside, jpath):
        raise OSError(f"could not create {path}")


def delete_tree(spark: SparkSession, path: str) -> None:
    fs, jpath = _open(spark, path)
    fs.delete(jpath, True)


def last_change(spark: SparkSession, path: str) -> int:
    """When a folder, or something directly in it, changed last, in milliseconds."""
    fs, jpath = _open(spark, path)
    return max([fs.getFileStatus(jpath).getModificationTime(), *(s.getModificationTime() for s in fs.listStatus(jpath))])


def switch(spark: SparkSession, new: str, place: str) -> None:
    """Put a folder in the place of another, which goes once the new one is there."""
    fs, source = _open(spark, new)
    path = spark._jvm.org.apache.hadoop.fs.Path
    target, old = path(place), path(f"{place.rstrip('/')}.old-{uuid.uuid4().hex[:12]}")
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"could not move {place}")
    if not fs.rename(source, target):
        fs.rename(old, target)
        raise OSError(f"could not switch {place}")
    fs.delete(old, True)


def partition_folder(spark: SparkSession, name: str, value) -> str:
    """``name=value`` as a partitioned write spells it; NULL has a name of its own."""
    text = None if value is None else str(value)
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(name, text)


def head_lines(spark: SparkSession, files: list[str], n: int, encoding: str = "utf-8") -> dict[str, list[str]]:
    """The first ``n`` lines of each file. One short read per file, so no scan of the data."""
    jvm = spark._jvm

    def read(path: str) -> list[str]:
        fs, jpath = _open(spark, path)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(jpath), encoding))
        try:
            lines = []
            for _ in range(n):
                line = reader.readLine()
                if line is None:
                    break
                lines.append(line)
            return lines
        finally:
            reader.close()

    with ThreadPoolExecutor(max_workers=16) as pool:
        return dict(zip(files, pool.map(read, files)))
