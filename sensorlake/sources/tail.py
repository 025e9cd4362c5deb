"""Following growing text files as a stream.

The offset holds a byte position per file of the folder, always just after a
line end: a line that is still being written waits until its end is there. A
micro-batch is the bytes between two offsets, cut into byte ranges that
executors read in parallel; a range has the lines that begin in it. A batch
that is run again reads the same bytes.

Finding the last line end reads backwards from a file's end, about one line; the
offset grows with the number of files in the folder, so finished files should
be moved away when they are many. A file that is shorter than its position was
replaced and is read from its start.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .folder import list_files, open_folder

FORMAT = "growing_text_files"
RANGE_BYTES = 8 << 20
BLOCK_BYTES = 64 << 10
BATCH_LINES = 1 << 14


@dataclass
class ByteRange(InputPartition):
    """Lines of ``name`` that begin in [``first``, ``last``); the new part of the
    file begins at ``begin``, where a line begins."""
    name: str
    begin: int
    first: int
    last: int


def end_of_lines(stream, size: int) -> int:
    """Position after the last line end before ``size``; 0 without one."""
    at = size
    while at > 0:
        start = max(0, at - BLOCK_BYTES)
        found = stream.read_at(at - start, start).rfind(b"\n")
        if found >= 0:
            return start + found + 1
        at = start
    return 0


def lines_of(stream, part: ByteRange) -> Iterator[tuple[int, bytes]]:
    """(position, line without its end) of a range."""
    at = part.first
    stream.seek(at)
    if at > part.begin:                      # the line that ``first`` is in belongs to the range before
        stream.seek(at - 1)
        at = at - 1 + len(stream.readline())
    while at < part.last:
        line = stream.readline()
        if not line.endswith(b"\n"):
            break                            # the file was cut off meanwhile
        yield at, line[:-1].removesuffix(b"\r")
        at += len(line)


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.uri, self.ending = options["path"], options.get("ending", "")
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        files, root = open_folder(self.uri)
        ends = {}
        for f in list_files(files, root, self.ending):
            with files.open_input_file(f.path) as stream:
                if end := end_of_lines(stream, f.size):
                    ends[f.path[len(root) + 1:]] = end
        return {"files": ends}

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        parts = []
        for name, last in end["files"].items():
            begin = start["files"].get(name, 0)
            begin = 0 if begin > last else begin
            parts += [ByteRange(name, begin, at, min(at + self.range_bytes, last)) for at in range(begin, last, self.range_bytes)]
        return parts or [ByteRange("", 0, 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        files, root = open_folder(self.uri)
        with io.BufferedReader(files.open_input_file(f"{root}/{partition.name}"), BLOCK_BYTES) as stream:
            held: list[tuple[int, bytes]] = []

            def batch():
                return pa.RecordBatch.from_arrays(
                    [pa.array([line.decode("utf-8", "replace") for _, line in held]), pa.array([partition.name] * len(held)),
                     pa.array([at for at, _ in held], pa.int64())], names=["value", "file", "position"])

            for row in lines_of(stream, partition):
                held.append(row)
                if len(held) >= BATCH_LINES:
                    yield batch()
                    held = []
            if held:
                yield batch()


class GrowingTextFiles(DataSource):
    """``spark.readStream.format("growing_text_files").option("path", folder)``: a row
    per complete line (``value``, ``file``, ``position`` in bytes); options ``ending`` of
    the files' names, ``range_bytes``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string, file string, position long"

    def streamReader(self, schema) -> TailReader:
        return TailReader(dict(self.options))
