"""CSV files that are read by name in the task: a Python data source over byte ranges.

A partition is a bundle of byte ranges of files. A task reads the first line of each file
it has a range of, finds the wanted columns in it, and parses only the lines that begin in
its range; the driver lists the files and reads none. Files are opened with `pyarrow.fs`.
"""

from __future__ import annotations

import csv
import fnmatch
import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import csv as pacsv, fs as pafs
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RANGE_BYTES = 32 << 20
FILE, PROBLEM = "_file", "_problem"


@dataclass(frozen=True)
class Part:
    path: str  # as the file system names it
    name: str  # as a URI
    start: int
    end: int


class Bundle(InputPartition):
    def __init__(self, parts: list[Part]) -> None:
        self.parts = parts


def _located(path: str) -> tuple[pafs.FileSystem, str, str]:
    """File system, path in it, and what goes before the path in a URI."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path, "file://"
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/"), "file://"
    system, inner = pafs.FileSystem.from_uri(path)
    return system, inner, path[: path.index("://") + 3] + path.split("://", 1)[1].split("/", 1)[0].removesuffix(inner.split("/")[0])


def _files(path: str) -> Iterator[tuple[pafs.FileInfo, str]]:
    """Data files of a file, a folder with its subfolders, or a pattern; hidden ones are left out."""
    system, inner, before = _located(path)
    fixed = inner.split("*")[0].split("?")[0].split("[")[0]
    if fixed != inner:
        found = system.get_file_info(pafs.FileSelector(fixed.rpartition("/")[0] or "/", recursive=True))
        depth = inner.count("/")
        found = [f for f in found if f.path.count("/") == depth and fnmatch.fnmatch(f.path, inner)]
        inside = [f for f in found if f.type == pafs.FileType.Directory]
        found = [f for f in found if f.type == pafs.FileType.File]
        for folder in inside:
            found += system.get_file_info(pafs.FileSelector(folder.path, recursive=True))
    else:
        info = system.get_file_info(inner)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(path)
        found = [info] if info.type == pafs.FileType.File else system.get_file_info(pafs.FileSelector(inner, recursive=True))
    root = fixed.rpartition("/")[0]
    for f in found:
        hidden = any(p[:1] in "_." for p in f.path[len(root):].split("/") if p)
        if f.type == pafs.FileType.File and f.size and not hidden:
            yield f, before + f.path


class HeadedReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict) -> None:
        self.wanted = [n for n in schema.names if n not in (FILE, PROBLEM)]
        self.names = schema.names
        self.paths = options["path"].split("\n")
        self.strict = options.get("bad", "fail") == "fail"
        self.range = int(options.get("range", RANGE_BYTES))

    def partitions(self) -> list[InputPartition]:
        bundles, held, size = [], [], 0
        for path in self.paths:
            for f, name in sorted(_files(path), key=lambda x: x[1]):
                step = f.size if f.path.endswith((".gz", ".bz2")) else self.range  # these cannot be split
                for start in range(0, f.size, step):
                    part = Part(f.path, name, start, min(start + step, f.size))
                    if held and size + part.end - part.start > self.range:
                        bundles.append(Bundle(held))
                        held, size = [], 0
                    held.append(part)
                    size += part.end - part.start
        return [*bundles, Bundle(held)] if held or not bundles else bundles

    def read(self, partition: Bundle) -> Iterator[pa.RecordBatch]:
        for part in partition.parts:
            system, _, _ = _located(part.name)
            header, body = _lines(system, part)
            names = [n.strip().strip('"').strip() for n in next(csv.reader([header.decode("utf-8-sig", "replace")]), [])]
            missing = [w for w in self.wanted if w not in names]
            if not missing:
                yield from self._parsed(part, body, [names.index(w) for w in self.wanted], len(names))
            elif self.strict:
                raise ValueError(f"the header of {part.name} has no {', '.join(missing)}")
            elif part.start == 0:
                yield self._batch(part, [pa.nulls(1, pa.string()) for _ in self.wanted], f"no column {', '.join(missing)}")

    def _parsed(self, part: Part, body: bytes, at: list[int], width: int) -> Iterator[pa.RecordBatch]:
        uneven: list[str] = []

        def keep(row) -> str:
            uneven.append(row.text)
            return "skip"

        if body.strip():
            cells = pacsv.read_csv(
                io.BytesIO(body),
                pacsv.ReadOptions(use_threads=False, column_names=[str(i) for i in range(width)], block_size=max(1 << 20, len(body))),
                pacsv.ParseOptions(escape_char="\\", invalid_row_handler=keep),
                pacsv.ConvertOptions(
                    include_columns=[str(i) for i in dict.fromkeys(at)], null_values=[""], strings_can_be_null=True,
                    quoted_strings_can_be_null=False, check_utf8=False,
                    column_types={str(i): pa.binary() for i in range(width)},
                ),
            )
            if cells.num_rows:
                yield self._batch(part, [_text(cells.column(str(i)).combine_chunks()) for i in at])
        if uneven:  # rows with fewer or more fields than the header
            rows = [next(csv.reader([line], escapechar="\\"), []) for line in uneven]
            yield self._batch(part, [pa.array([r[i] or None if i < len(r) else None for r in rows], pa.string()) for i in at])

    def _batch(self, part: Part, columns: list[pa.Array], problem: str | None = None) -> pa.RecordBatch:
        n = len(columns[0])
        by = dict(zip(self.wanted, columns)) | {FILE: pa.array([part.name] * n), PROBLEM: pa.array([problem] * n, pa.string())}
        return pa.RecordBatch.from_arrays([by[c] for c in self.names], names=self.names)


def _text(cells: pa.Array) -> pa.Array:
    try:
        return cells.cast(pa.string())
    except pa.ArrowInvalid:  # not UTF-8
        return pa.array([None if c is None else c.decode("utf-8", "replace") for c in cells.to_pylist()], pa.string())


def _lines(system: pafs.FileSystem, part: Part) -> tuple[bytes, bytes]:
    """The first line of a file, and the lines after it that begin in the range."""
    if part.path.endswith((".gz", ".bz2")):
        with system.open_input_stream(part.path) as file:
            header, _, body = file.read().partition(b"\n")
        return header, body
    with system.open_input_file(part.path) as file:
        header = _rest_of_line(file)
        first = len(header)
        if part.start > first:
            file.seek(part.start - 1)
            first = part.start - 1 + len(_rest_of_line(file))
        if first >= part.end:
            return header, b""
        file.seek(first)
        body = file.read(part.end - first)
        if not body.endswith(b"\n"):
            body += _rest_of_line(file)
        return header, body


def _rest_of_line(file: pa.NativeFile) -> bytes:
    """Bytes up to and with the next line end."""
    found = b""
    while True:
        block = file.read(1 << 14)
        cut = block.find(b"\n")
        if cut >= 0 or not block:
            return found + (block[: cut + 1] if cut >= 0 else b"")
        found += block


class HeadedCsv(DataSource):
    """`headed_csv`: columns of CSV files by the name that each file's first line gives them.

    Options: `path` (several by line feeds), `range` (bytes), `bad` ("fail", or "row": a file
    without a wanted column becomes one row with its name and what it lacks).
    """

    @classmethod
    def name(cls) -> str:
        return "headed_csv"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return HeadedReader(schema, self.options)


def read_headed(spark: SparkSession, path, columns, bad: str = "fail", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Text columns of CSV files with the file's name in `_file` and, for bad files, `_problem`."""
    spark.dataSource.register(HeadedCsv)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, FILE, PROBLEM]])
    paths = [path] if isinstance(path, str) else list(path)
    return (
        spark.read.format("headed_csv").schema(schema).option("bad", bad).option("range", str(range_bytes))
        .option("path", "\n".join(paths)).load()
    )
