"""Text files with dependable names: one file per partition, committed at once.

Spark names the files of a write after its tasks and a random word.  A result
of ``num_files`` named files -- ``part-r-00000`` is partition 0, and so on, an
empty partition an empty file -- can be read back by (file, position) and told
apart by its base name.  ``commit_text`` lets Spark write the rows into a
staging folder beside the target, renames the files there, and renames the
folder last, so a reader sees all files or none.  The driver handles
``num_files`` names; no row passes through it.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame

PREFIX = "part-r-"
_WRITTEN = re.compile(r"part-(\d+)-.*")


def _hadoop(df: DataFrame, path: str):
    jvm = df.sparkSession._jvm
    make = jvm.org.apache.hadoop.fs.Path
    return make, make(path).getFileSystem(df.sparkSession._jsc.hadoopConfiguration())


def commit_text(parts: DataFrame, line: Column, path: str, num_files: int, prefix: str = PREFIX,
                mode: str = "errorifexists") -> None:
    """Writes partition ``k`` of ``parts``, rows in the order they have there,
    as the lines of the file ``<prefix>k`` in the folder ``path``.

    ``mode`` is ``errorifexists`` or ``overwrite`` (the old folder goes when the
    new one is complete).
    """
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"mode {mode}")
    path = path.rstrip("/")
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    make, fs = _hadoop(parts, path)
    if mode == "errorifexists" and fs.exists(make(path)):
        raise FileExistsError(path)
    try:
        parts.select(line.alias("value")).write.option("maxRecordsPerFile", 0).text(staging)
        seen = set()
        for status in fs.listStatus(make(staging)):
            found = _WRITTEN.match(status.getPath().getName())
            if found:
                number = int(found[1])
                seen.add(number)
                if not fs.rename(status.getPath(), make(f"{staging}/{prefix}{number:05d}")):
                    raise OSError(f"cannot rename {status.getPath()}")
        for number in set(range(num_files)) - seen:
            fs.create(make(f"{staging}/{prefix}{number:05d}")).close()
        if mode == "overwrite":
            fs.delete(make(path), True)
        if not fs.rename(make(staging), make(path)):
            raise OSError(f"cannot rename {staging} to {path}")
    except BaseException:
        fs.delete(make(staging), True)
        raise


def write_ranges(df: DataFrame, line: Column, keys: list[str], path: str, num_files: int, **options) -> None:
    """``num_files`` files of ascending, disjoint ranges of ``keys``, each sorted."""
    commit_text(df.repartitionByRange(num_files, *keys).sortWithinPartitions(*keys), line, path, num_files, **options)


def write_partitions(df: DataFrame, line: Column, part: str, keys: list[str], path: str, num_files: int, **options) -> None:
    """File ``k`` holds the rows whose column ``part`` (int, from 0 below
    ``num_files``) is ``k``, sorted by ``keys``."""
    commit_text(df.repartitionById(num_files, part).sortWithinPartitions(*keys), line, path, num_files, **options)
