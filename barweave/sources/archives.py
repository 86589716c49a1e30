"""Lines of landed files as a data source: one partition per member of an archive.

The listing and the archives' central directories are read when a query is planned, so the
day of a line and its member's number among the day's are known before a byte of content is, and
need no join. Tasks read their own member's bytes only, as a stream; plain files, mostly
small, share tasks up to ``PACKED_BYTES``.
"""

from __future__ import annotations

import io
import json
import re
import zipfile
import zlib
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from barweave.schemas import ARCHIVE_DAY_PATTERN, SPREAD_ARCHIVE_PATTERN

FORMAT = "landed_lines"
MEMBER_LINES = (
    "ds date, file_no bigint, source_file string, member string, line_no bigint, line string"
)
BATCH_LINES = 20_000
PACKED_BYTES = 32 << 20
READ_BYTES = 1 << 18
OPEN_BYTES = 1 << 20  # what opening a file costs, as bytes read
LISTERS = 16
# Stores that tasks reach without Hadoop's classes; others are read by whole files.
SCHEMES = {"file": "file", "s3": "s3", "s3a": "s3", "gs": "gs"}


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its store, that of the cluster's default where it names none."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.makeQualified(hadoop).toString()


def has_members(path: str) -> bool:
    return path.split(":", 1)[0] in SCHEMES


def member_lines(
    spark: SparkSession,
    path: str,
    days: list[str] | None = None,
    charset: str = "utf-8",
    zipped: bool = False,
) -> DataFrame:
    """``MEMBER_LINES`` of the files in a folder, or of those whose names hold one of ``days``.

    ``file_no`` is the place, from 1, of a file or member among those of its day: outright
    archives, then spread ones, by name, then as in the archive. ``line_no`` counts from 0. Lines end
    with CR LF. A name without a day has a null ``ds``. Empty folders give no rows; an absent folder
    and an archive that is cut, damaged or none are errors.
    """
    spark.dataSource.register(LandedLines)
    return (
        spark.read.format(FORMAT)
        .option("folder", qualified(spark, path))
        .option("days", json.dumps(days))
        .option("charset", charset)
        .option("zipped", str(zipped))
        .option("batch_lines", str(BATCH_LINES))
        .load()
    )


def _store(uri: str):
    """A file system and the path in it."""
    from pyarrow import fs

    scheme, rest = uri.split(":", 1)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{SCHEMES[scheme]}:{quote(rest, safe='/')}")


class _Raw(io.RawIOBase):
    """A store's file by Python's rules: a place before its start is an ``OSError``."""

    def __init__(self, file):
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.file.tell()

    def readinto(self, buffer) -> int:
        return self.file.readinto(buffer)

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        start = {io.SEEK_SET: 0, io.SEEK_CUR: self.file.tell(), io.SEEK_END: self.file.size()}[whence]
        if start + offset < 0:
            raise OSError(f"place {start + offset}")
        return self.file.seek(start + offset)


@contextmanager
def _opened(uri: str):
    store, path = _store(uri)
    with store.open_input_file(path) as file:
        yield io.BufferedReader(_Raw(file), READ_BYTES)


@contextmanager
def _archive(uri: str):
    """An archive; what is wrong with it is told with its name."""
    with _opened(uri) as file:
        try:
            with zipfile.ZipFile(file) as archive:
                yield archive
        except (zipfile.BadZipFile, zlib.error, EOFError) as error:
            raise ValueError(f"archive {uri}: {error}") from error


@dataclass(frozen=True)
class Piece:
    """A file, or the member at a place of an archive."""

    uri: str
    name: str
    at: int | None
    length: int
    ds: date | None = None
    file_no: int = 0


@dataclass
class Pieces(InputPartition):
    pieces: list[Piece]


def _day_of(name: str) -> date | None:
    found = re.search(ARCHIVE_DAY_PATTERN, name)
    try:
        return datetime.strptime(found.group(1), "%Y_%m_%d").date() if found else None
    except ValueError:
        return None


def numbered(pieces: list[Piece]) -> list[Piece]:
    """Pieces with their day and their number among the day's."""

    def place(piece: Piece):
        name = piece.uri.rsplit("/", 1)[1]
        return bool(re.search(SPREAD_ARCHIVE_PATTERN, name)), name, piece.at or 0

    last: dict[date | None, int] = {}
    out = []
    for piece in sorted(pieces, key=place):
        ds = _day_of(piece.uri.rsplit("/", 1)[1])
        last[ds] = last.get(ds, 0) + 1
        out.append(Piece(piece.uri, piece.name, piece.at, piece.length, ds, last[ds]))
    return out


def packed(pieces: list[Piece]) -> list[Pieces]:
    """A partition per member; plain files together, as long as they are small."""
    out: list[Pieces] = []
    room = 0
    for piece in pieces:
        cost = piece.length + OPEN_BYTES
        if piece.at is not None:
            out.append(Pieces([piece]))
            continue
        if not out or cost > room:
            out.append(Pieces([]))
            room = PACKED_BYTES
        out[-1].pieces.append(piece)
        room -= cost
    return out


class LandedLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return MEMBER_LINES

    def reader(self, schema) -> LandedReader:
        return LandedReader(self.options)


class LandedReader(DataSourceReader):
    def __init__(self, options):
        self.folder = options["folder"]
        self.days = json.loads(options["days"])
        self.charset = options["charset"]
        self.zipped = options["zipped"] == "True"
        self.batch_lines = int(options["batch_lines"])

    def _files(self) -> list[Piece]:
        from pyarrow import fs

        store, folder = _store(self.folder)
        found = []
        for info in store.get_file_info(fs.FileSelector(folder)):
            name = info.base_name
            wanted = not self.days or any(day in name for day in self.days)
            if info.type == fs.FileType.File and wanted and name[0] not in "._":
                found.append(Piece(f"{self.folder}/{name}", f"{self.folder}/{name}", None, info.size))
        return found

    def partitions(self) -> list[Pieces]:
        def members(file: Piece) -> list[Piece]:
            with _archive(file.uri) as archive:
                return [
                    Piece(file.uri, info.filename, at, info.compress_size)
                    for at, info in enumerate(archive.infolist())
                    if not info.is_dir()
                ]

        pieces = self._files()
        if self.zipped:
            with ThreadPoolExecutor(LISTERS) as pool:
                pieces = [member for file in pool.map(members, pieces) for member in file]
        return packed(numbered(pieces))

    def read(self, partition: Pieces | None):
        for piece in partition.pieces if partition else ():
            if piece.at is None:
                with _opened(piece.uri) as stream:
                    yield from self._batches(piece, stream)
            else:
                with _archive(piece.uri) as archive:
                    with archive.open(archive.infolist()[piece.at]) as stream:
                        yield from self._batches(piece, stream)

    def _batches(self, piece: Piece, stream):
        import pyarrow as pa

        def batch(first: int, lines: list[str]) -> pa.RecordBatch:
            n = len(lines)
            columns = {
                "ds": pa.array([piece.ds] * n, pa.date32()),
                "file_no": pa.array([piece.file_no] * n, pa.int64()),
                "source_file": pa.array([piece.uri] * n, pa.string()),
                "member": pa.array([piece.name] * n, pa.string()),
                "line_no": pa.array(range(first, first + n), pa.int64()),
                "line": pa.array(lines, pa.string()),
            }
            return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        lines, first = [], 0
        for line in io.TextIOWrapper(stream, self.charset, "replace", newline="\r\n"):
            lines.append(line.rstrip("\r\n"))
            if len(lines) == self.batch_lines:
                yield batch(first, lines)
                first, lines = first + len(lines), []
        if lines:
            yield batch(first, lines)
