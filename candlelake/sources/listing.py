"""File listing in tasks: one folder a row, level by level, so the driver holds no file names."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.session import settle

ENTRIES = "path string, size bigint, folder boolean"
NAMES = 10_000       # entries of a record batch
FILES_A_TASK = 2_000
FOLDERS_A_ROW = 16    # a task lists this many folders from one that it is given

Store = Callable[[str], tuple[fs.FileSystem, str]]


def open_store(base: str) -> tuple[fs.FileSystem, str]:
    """The file system that begins with ``base`` (scheme and authority), and what its paths begin with."""
    scheme, _, authority = base.partition(":")
    uri = f"{re.sub('^s3[an]$', 's3', scheme)}:{authority or '//'}/"
    system, start = fs.FileSystem.from_uri(uri)
    return system, start.rstrip("/")


def _hidden(name: str) -> bool:
    """Names that a scan leaves out too."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def deal(rows: DataFrame, a_task: int) -> DataFrame:
    """Rows with a ``path`` spread over the cluster, about ``a_task`` of them to a task at most."""
    n, least = rows.count(), 4 * rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(1, min(n, max(least, -(-n // a_task)))), "path")


def walk(spark: SparkSession, base: str, folders: list[str], store: Store = open_store) -> DataFrame:
    """Columns ``path``, ``size`` of the files below ``folders`` (paths without ``base``), at any depth.

    A task lists a folder and the first few below it, and hands the others on to the next level, which is
    dealt anew. The names of one folder have to fit a task; nothing else is bounded. Folders that vanish
    meanwhile are left out, and so are hidden names.
    """
    def entries(system: fs.FileSystem, start: str, folder: str) -> Iterator[tuple[str, int, bool]]:
        own = [folder]
        for here in own:      # grows while it is read
            for f in system.get_file_info(fs.FileSelector(start + here, allow_not_found=True)):
                name = f.path.rsplit("/", 1)[-1]
                below, is_folder = f"{here.rstrip('/')}/{name}", f.type == fs.FileType.Directory
                if is_folder and not _hidden(name) and len(own) < FOLDERS_A_ROW:
                    own.append(below)
                elif not _hidden(name):
                    yield below, f.size or 0, is_folder

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, start = store(base)
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                found = entries(system, start, folder)
                while part := list(islice(found, NAMES)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(values, kind) for values, kind in zip(zip(*part), (pa.string(), pa.int64(), pa.bool_()))],
                        names=["path", "size", "folder"])

    level, files = spark.createDataFrame([(f,) for f in folders], "path string"), None
    while True:
        seen = settle(deal(level, 100).mapInArrow(look, ENTRIES), "listing")
        here = seen.where("NOT folder").select("path", "size")
        files = here if files is None else files.unionByName(here)
        level = seen.where("folder").select("path")
        if level.isEmpty():
            return files


def split_root(spark: SparkSession, root: str) -> tuple[str, list[str]]:
    """Scheme and authority of ``root``, and the paths it names: a folder, a file or a pattern of these."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(root)
    found = [s.getPath().toUri() for s in place.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(place) or []]
    if not found:
        raise FileNotFoundError(root)
    scheme, authority = found[0].getScheme(), found[0].getAuthority()
    return f"{scheme}:" + (f"//{authority}" if authority else ""), [uri.getPath() for uri in found]


def list_files(spark: SparkSession, root: str, suffix: str = "", store: Store = open_store) -> DataFrame:
    """Columns ``base``, ``path`` (without it), ``size`` of all files below ``root`` whose name ends with ``suffix``.

    ``store`` opens the file system in the tasks; give one where its credentials are not in the environment.
    """
    base, paths = split_root(spark, root)
    system, start = store(base)
    single = [i for i in system.get_file_info([start + p for p in paths]) if i.type == fs.FileType.File]
    ends = {i.path for i in single}
    files = walk(spark, base, [p for p in paths if start + p not in ends], store)
    if single:
        files = files.unionByName(spark.createDataFrame([(i.path[len(start):], i.size) for i in single], files.schema))
    return files.where(F.col("path").endswith(suffix)).select(F.lit(base).alias("base"), "path", "size")
