"""A data source for registers as text: delimited files that each have a preamble and a header of their own.

Files are read by byte ranges. A reader finds its file's header first (from the file's start, as far as the header goes),
then reads the lines that begin in its range; a range of megabytes streams through a task's memory in batches."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a range, and lines of a batch.
RANGE, BATCH = 128 << 20, 5_000
#: Columns behind the register's own: the file, the line's first byte, fields beyond the header's, the text above the header.
ABOUT = ("_file", "_offset", "_rest", "_preamble")


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(re.sub("^file:/*", "/", path))


def files_of(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of a file, or of all files below a folder but hidden ones and markers."""
    system, at = opened(path)
    info = system.get_file_info(at)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    found = [f for f in system.get_file_info(fs.FileSelector(at, recursive=True)) if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))]
    head = re.sub("^file:/*", "/", path)
    return sorted((f.path if head.startswith("/") else f"{head.split('://')[0]}://{f.path}", f.size) for f in found)


def lines_of(path: str) -> io.BufferedReader:
    system, at = opened(path)
    return io.BufferedReader(system.open_input_file(at), 1 << 20)


class Range(InputPartition):
    def __init__(self, path: str, begin: int, end: int):
        self.path, self.begin, self.end = path, begin, end


class RegisterReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]):
        self.options, self.columns = options, columns
        self.sep, self.quote = options.get("sep", ","), options.get("quote", '"')
        self.encoding, self.trim = options.get("encoding", "utf-8-sig"), options.get("trim", "false").lower() == "true"
        self.skip = re.compile(options["skip_until"]) if options.get("skip_until") else None
        self.header = options.get("header", "true").lower() == "true"

    def partitions(self) -> list[Range]:
        step = int(self.options.get("range_bytes", RANGE))
        return [Range(p, at, min(at + step, size)) for p, size in files_of(self.options["path"]) for at in range(0, size, step)]

    def fields(self, lines: Iterator[str]) -> Iterator[list[str]]:
        rows = csv.reader(lines, delimiter=self.sep, quotechar=self.quote or None, quoting=csv.QUOTE_MINIMAL if self.quote else csv.QUOTE_NONE)
        return ([x.strip() for x in r] for r in rows) if self.trim else rows

    def head(self, file) -> tuple[list[str], str, int]:
        """(names, text above the header, first byte behind the header) of a file."""
        if not self.header:
            return list(self.columns), "", 0
        above, at = [], 0
        while raw := file.readline():
            at += len(raw)
            line = raw.decode(self.encoding, "replace").strip("\r\n﻿")
            if not self.skip and line or self.skip and self.skip.search(line):
                return [x.strip() for x in next(self.fields([line]))], "\n".join(above), at
            above.append(line)
        raise ValueError(f"no line of a register's file matches {self.skip.pattern if self.skip else 'a header'}")

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        with lines_of(part.path) as file:
            names, above, body = self.head(file)
            of = {n: i for i, n in reversed(list(enumerate(names)))}
            places = [of.get(c) for c in self.columns]
            begin = max(part.begin, body)
            if begin > body:  # a line belongs to the range that its first byte lies in
                file.seek(begin - 1)
                begin += len(file.readline()) - 1
            else:
                file.seek(begin)
            while begin < part.end:
                lines, offsets = [], []
                while begin < part.end and len(lines) < BATCH and (raw := file.readline()):
                    text = raw.decode(self.encoding.removesuffix("-sig"), "replace").strip("\r\n")
                    if text.strip():
                        lines.append(text)
                        offsets.append(begin)
                    begin += len(raw)
                if not lines and begin < part.end and not raw:
                    return
                if lines:
                    yield self.batch(part.path, lines, offsets, places, len(names), above)

    def batch(self, path: str, lines: list[str], offsets: list[int], places: list[int | None], width: int, above: str) -> pa.RecordBatch:
        rows = [next(self.fields([x])) for x in lines]
        own = [pa.array([r[p] if p is not None and p < len(r) else None for r in rows], pa.string()) for p in places]
        rest = pa.array([self.sep.join(r[width:]) if len(r) > width else None for r in rows], pa.string())
        about = [pa.array([path] * len(rows), pa.string()), pa.array(offsets, pa.int64()), rest, pa.array([above] * len(rows), pa.string())]
        return pa.RecordBatch.from_arrays([*own, *about], [*self.columns, *ABOUT])


class RegisterText(DataSource):
    """``spark.read.format("register_text")``: options path, columns (names, one a line; by default the first file's header),
    sep, quote, encoding, trim, header, skip_until (a pattern of the header's line), range_bytes.

    Columns are found by each file's own header; those a file lacks are null, and so are the fields that a short row lacks.
    Fields beyond the header's go to ``_rest``. A quoted field must not run over lines."""

    @classmethod
    def name(cls) -> str:
        return "register_text"

    def columns(self) -> list[str]:
        if self.options.get("columns"):
            return self.options["columns"].split("\n")
        found = files_of(self.options["path"])
        if not found:
            raise ValueError(f"no file at {self.options['path']}")
        with lines_of(found[0][0]) as file:
            return RegisterReader(dict(self.options), []).head(file)[0]

    def schema(self) -> str:
        own = ", ".join(f"`{c}` string" for c in self.columns())
        return f"{own}, _file string, _offset long, _rest string, _preamble string"

    def reader(self, schema) -> RegisterReader:
        return RegisterReader(dict(self.options), [f.name for f in schema.fields if f.name not in ABOUT])
