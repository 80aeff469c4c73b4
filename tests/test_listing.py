"""Files are listed in tasks: any depth, empty files, patterns, odd names, and very many names."""

from __future__ import annotations

import zipfile

import pyarrow.fs as fs
import pytest

from candlelake.sources import archives, listing


def test_a_hundred_thousand_names(spark):
    class Entry:
        def __init__(self, path, size, type_):
            self.path, self.size, self.type = path, size, type_

    class Many:
        """A store of 100,000 names: 200 folders of 500 files, every hundredth file empty."""

        def get_file_info(self, selector):
            folder = selector.base_dir
            if folder.endswith("/lake"):
                return [Entry(f"{folder}/c{i}", 0, fs.FileType.Directory) for i in range(200)]
            return [Entry(f"{folder}/{folder[-3:].strip('/')}-{i}.zip", i % 100, fs.FileType.File) for i in range(500)]

    files = listing.walk(spark, "many:", ["/lake"], lambda base: (Many(), ""))
    assert files.count() == 100_000 and files.select("path").distinct().count() == 100_000
    assert files.where("size = 0").count() == 1_000


@pytest.fixture()
def folder(tmp_path):
    deep = tmp_path / "a b" / "x=1%"
    deep.mkdir(parents=True)
    with zipfile.ZipFile(deep / "AUSDT-1m-2024-01.zip", "w") as z:
        z.writestr("AUSDT-1m-2024-01.csv", "1")
    (deep / "BUSDT-1m-2024-01.zip").write_bytes(b"")
    (deep / "note.txt").write_text("no archive")
    (tmp_path / "CUSDT-1m-2024-01.zip").write_bytes(b"broken")
    for hidden in (".tmp", "_staging"):
        (tmp_path / hidden).mkdir()
        (tmp_path / hidden / "DUSDT-1m-2024-01.zip").write_bytes(b"")
    return tmp_path


def names(rows):
    return {r["path"].rsplit("/", 1)[1][0] for r in rows.collect()}


def test_listing_finds_what_a_scan_finds(spark, folder):
    files = listing.list_files(spark, str(folder), ".zip")
    assert names(files) == {"A", "B", "C"}
    scanned = {r["path"] for r in archives._files(spark, str(folder)).select("path").collect()}
    listed = {r["base"] + r["path"] for r in files.where("size > 0").collect()}
    assert listed == scanned
    assert names(listing.list_files(spark, str(folder / "C*"), ".zip")) == {"C"}        # a file
    assert names(listing.list_files(spark, str(folder / "a*"), ".zip")) == {"A", "B"}   # a pattern
    empty = folder / "none"
    empty.mkdir()
    assert listing.list_files(spark, str(empty)).count() == 0
    with pytest.raises(FileNotFoundError):
        listing.list_files(spark, str(folder / "absent"))


def test_inventory_reads_directories_only(spark, folder):
    rows = {r["file_name"][0]: r for r in archives.inventory(spark, str(folder)).collect()}
    assert rows["A"]["error"] is None and rows["A"]["size"] > 0
    assert "no bytes" in rows["B"]["error"] and "not a zip" in rows["C"]["error"]
    assert set(rows) == {"A", "B", "C"}

    class Counted:
        """A store that counts what is read of a large file."""
        read = 0

        def open_input_file(self, path):
            source, counted = open(path, "rb"), self

            class File:
                closed = False
                seek, tell = source.seek, source.tell

                def read(self, n=-1):
                    data = source.read(n)
                    counted.read += len(data)
                    return data

                def seekable(self):
                    return True

                def __enter__(self):
                    return self

                def __exit__(self, *_):
                    source.close()

            return File()

    path = folder / "EUSDT-1m-2024-01.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr("EUSDT-1m-2024-01.csv", "1" * 5_000_000)
    store = Counted()
    assert archives._fault(store, str(path), 5_000_000) is None
    assert store.read < 200_000
