"""Candle archives: zip files that each hold one headerless CSV."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from decimal import Decimal, InvalidOperation
from typing import BinaryIO

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.functions.keys import LARGEST_MILLIS, LARGEST_TIME
from candlelake.schemas import ARCHIVE_LINES, KLINE_FIELDS
from candlelake.sources.listing import FILES_A_TASK, Store, deal, list_files, open_store

NO_BYTES = "no bytes"
WHOLE = 1 << 17      # archives up to this size are read whole to look at their directory
PIECE = 8 << 20      # bytes of a member that a task has at hand

# A key is a whole number: digits, perhaps with a sign, an empty fraction, or an exponent that leaves no fraction.
# These are plainly times: milliseconds of up to 13 digits, or microseconds of up to 16, before the year 2255.
_PLAIN_KEY = r"^\s*\+?(\d{1,12}|[1-8]\d{12}|[1-9]\d{13,14}|[1-8]\d{15})(\.0*)?\s*(,|$)"
_PAIR_NAME = re.compile(r"[^/]+?-\w+-\d{4}-\d{2}(?:-\d{2})?\.zip$")


def _check_key(line: str) -> None:
    """Reject an unusual key that is no whole number, or no time: ``1.7e12`` is both."""
    try:
        key = Decimal(line.split(",", 1)[0].strip())
        whole = key.is_finite() and key == key.to_integral_value()
    except InvalidOperation:
        whole = False
    if not whole:
        raise ValueError("first column is not numeric")
    millis = LARGEST_TIME // 1_000
    if not (-millis <= key <= millis or LARGEST_MILLIS < key <= LARGEST_TIME):
        raise ValueError("first column is out of range")


def _pieces(archive: zipfile.ZipFile, member: str) -> Iterator[pa.Array]:
    """The member's non-blank lines, in pieces of bounded size that end with a line."""
    with archive.open(member) as stream:
        rest = b""
        while True:
            read = stream.read(PIECE)
            at = len(rest) + read.rfind(b"\n") if read else len(rest)
            data = rest + read
            if read and b"\n" not in read:
                rest = data
                continue
            text, rest = (data[:at], data[at + 1:]) if read else (data, b"")
            lines = pc.split_pattern(pa.array([text.decode("utf-8")], pa.large_string()), "\n")
            lines = pc.utf8_rtrim(pc.list_flatten(lines), "\r").cast(pa.string())
            kept = lines.filter(pc.greater(pc.utf8_length(pc.utf8_trim_whitespace(lines)), 0))
            if len(kept):
                yield kept
            if not read:
                return


def _check(archive: zipfile.ZipFile, member: str) -> None:
    """Reject a file that is not a candle table; later short lines only lack values."""
    expected, first = len(KLINE_FIELDS), True
    for lines in _pieces(archive, member):
        fields = pc.add(pc.count_substring(lines, ","), 1)
        if (first and fields[0].as_py() != expected) or pc.max(fields).as_py() > expected:
            raise ValueError(f"not {expected} columns")
        odd = lines.filter(pc.invert(pc.match_substring_regex(lines, _PLAIN_KEY)))
        for line in odd:
            _check_key(line.as_py())
        first = False
    if first:
        raise ValueError("no rows")


def _open(path: str, content: bytes | BinaryIO) -> tuple[zipfile.ZipFile, str]:
    """The archive and its member, which is named like it; of an open file only its end is read."""
    if not _PAIR_NAME.search(path):
        raise ValueError("no pair in the name")
    source = io.BytesIO(content) if isinstance(content, bytes) else content
    if not zipfile.is_zipfile(source):
        raise ValueError("not a zip file")
    archive = zipfile.ZipFile(source)
    member = path.rsplit("/", 1)[-1].removesuffix(".zip") + ".csv"
    archive.getinfo(member)
    return archive, member


def _batch(path: str, start: int, lines: pa.Array, error: str | None) -> pa.RecordBatch:
    n = len(lines)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([path], pa.string()).take(pa.array([0] * n)), pa.array(range(start, start + n), pa.int64()), lines,
            pa.array([error] * n, pa.string()),
        ],
        names=["path", "line_no", "line", "error"],
    )


def _fault(system: fs.FileSystem, path: str, size: int) -> str | None:
    """What is wrong with a landed archive, as far as its name, size and directory tell."""
    if not size:
        return f"ValueError: {NO_BYTES}"
    try:
        with system.open_input_file(path) as source:
            _open(path, source.read() if size <= WHOLE else source)
    except Exception as error:  # a bad file must not stop the others
        return f"{type(error).__name__}: {error}"
    return None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    none = pa.array([None], pa.string())
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            name = path.as_py()
            try:
                archive, member = _open(name, content.as_py())
                _check(archive, member)      # a whole pass first: a bad line rejects its file
            except Exception as error:  # a bad file must not stop the others
                yield _batch(name, 0, none, f"{type(error).__name__}: {error}")
                continue
            start = 0
            for lines in _pieces(archive, member):
                yield _batch(name, start, lines, None)
                start += len(lines)


def _files(spark: SparkSession, root: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true")
        .load(root).select("path", "content")
    )


def _empty(spark: SparkSession, root: str, store: Store) -> DataFrame:
    """Error rows of the files without bytes, which a scan skips; the listing still names them."""
    empty = list_files(spark, root, ".zip", store).where("size = 0")
    return empty.select(F.concat("base", "path").alias("path"), F.lit(0).cast("bigint").alias("line_no"),
                        F.lit(None).cast("string").alias("line"), F.lit(f"ValueError: {NO_BYTES}").alias("error"))


def read_archives(spark: SparkSession, root: str, store: Store = open_store) -> DataFrame:
    """Lines of all archives below ``root``, one task per group of files; bad files give an error row."""
    return _files(spark, root).mapInArrow(_read, ARCHIVE_LINES).unionByName(_empty(spark, root, store))


def inventory(spark: SparkSession, root: str, store: Store = open_store) -> DataFrame:
    """One row per landed archive, with an error where it has no bytes, no pair in its name, no zip or no member.

    Files are listed and opened in tasks, and of each only the directory at its end is read. Columns ``path``,
    ``file_name``, ``size``, ``error``.
    """
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = None
        for batch in batches:
            columns = batch.to_pydict()
            errors = []
            for base, path, size in zip(columns["base"], columns["path"], columns["size"]):
                system, start = opened = opened or store(base)
                errors.append(_fault(system, start + path, size))
            yield batch.append_column("error", pa.array(errors, pa.string()))

    listed = deal(list_files(spark, root, ".zip", store), FILES_A_TASK)
    rows = listed.mapInArrow(look, "base string, path string, size bigint, error string")
    return rows.select(F.concat("base", "path").alias("path"), F.expr("element_at(split(path, '/'), -1)").alias("file_name"),
                       "size", "error")
