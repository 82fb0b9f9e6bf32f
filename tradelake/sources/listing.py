"""Object listing.

``binaryFile`` with ``recursiveFileLookup`` lists a folder tree as a DataFrame;
the file contents are pruned from the scan, so only metadata is read. Folders of a
pattern are looked through level by level until a ``*`` is met, so a literal or ranged
level is not descended into where it cannot match; what is under the folders left is
listed by Spark (in tasks, if there are many). Like every Spark file source it skips names starting with ``_`` or ``.`` (markers such as
``_SUCCESS``, checksum files); the reference does not.
"""

from __future__ import annotations

import posixpath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..operators.files import ANYTHING, has_wildcard, match_files, open_steps, pattern_steps, root_prefix, split_uri


class NoMatchingFiles(FileNotFoundError):
    pass


def _not_found(exc: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(exc)


def qualified(spark: SparkSession, pattern: str) -> str:
    """A relative path or pattern below the file system's working folder, others as they are.

    Listings hold absolute paths, so a relative pattern could never match one."""
    scheme, path = split_uri(pattern)
    if scheme or path.startswith("/"):
        return pattern
    jvm = spark.sparkContext._jvm
    system = jvm.org.apache.hadoop.fs.FileSystem.get(spark.sparkContext._jsc.hadoopConfiguration())
    scheme, working = split_uri(system.getWorkingDirectory().toString())
    return scheme + posixpath.normpath(f"{working}/{pattern}")


def _children(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """``(path, is a folder)`` of what is directly in a folder, without the names that Spark skips."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(target):
        raise NoMatchingFiles(folder)
    found = [(s.getPath().toString(), s.isDirectory()) for s in system.listStatus(target)]
    return [(p, d) for p, d in found if p.rsplit("/", 1)[-1][:1] not in ("_", ".")]


def pattern_roots(spark: SparkSession, pattern: str) -> tuple[list[str], list[str]]:
    """Folders (and files) that hold all matches of a pattern, and the folders looked into to find them.

    A folder whose path ends inside a ``*`` is a root: the ``*`` crosses ``/``, so everything below
    it may match. Others are looked into, and only children that can still match are kept.
    """
    steps, todo = pattern_steps(pattern), [root_prefix(pattern)]
    roots, looked = [], []
    while todo:
        folder = todo.pop()
        at = open_steps(steps, split_uri(folder)[1].rstrip("/") + "/")
        if any(i < len(steps) and steps[i] == ANYTHING for i in at):
            roots.append(folder)
            continue
        looked.append(folder)
        for path, is_folder in _children(spark, folder):
            at = open_steps(steps, split_uri(path)[1] + ("/" if is_folder else ""))
            if is_folder and at:
                todo.append(path)
            elif len(steps) in at:
                roots.append(path)
    return sorted(roots), looked


def list_prefix(spark: SparkSession, *roots: str) -> DataFrame:
    """``path, length, modificationTime`` of every file under the given folders."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(list(roots))
        .select("path", "length", "modificationTime")
    )


def list_files(spark: SparkSession, pattern: str, require_match: bool = True) -> DataFrame:
    """Files matching a wildcard (S9) or a single explicit path.

    Raises ``NoMatchingFiles`` when nothing matches and ``require_match`` is set
    (the reference aborts in that case).
    """
    pattern = qualified(spark, pattern)
    try:
        if has_wildcard(pattern):
            roots, _ = pattern_roots(spark, pattern)
            if not roots:
                if require_match:
                    raise NoMatchingFiles(pattern)
                return spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
            files = match_files(list_prefix(spark, *roots), pattern)
        else:
            files = list_prefix(spark, pattern)
    except AnalysisException as exc:  # the root itself does not exist
        if _not_found(exc):
            raise NoMatchingFiles(pattern) from exc
        raise
    if require_match and files.isEmpty():
        raise NoMatchingFiles(pattern)
    return files


def exists_any(spark: SparkSession, root: str) -> bool:
    """Existence probe (S8, L2): at least one file under ``root``. Only a missing path
    means "none"; denied access or an unknown scheme is an error."""
    try:
        return not list_prefix(spark, qualified(spark, root)).isEmpty()
    except AnalysisException as exc:
        if _not_found(exc):
            return False
        raise


def preview(files: DataFrame, n: int = 5) -> list[str]:
    """First ``n`` paths, for log lines (L3). Bounded by ``n``."""
    return [r.path for r in files.select("path").orderBy("path").limit(n).collect()]
