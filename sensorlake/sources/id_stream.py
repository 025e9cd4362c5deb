"""A reading table as a stream by id offset.

The offset is ``{"id": n}``: a micro-batch is the rows with start < id <= end,
wherever they are in the folder, so a table that grows by files or a folder
that gets rewritten into larger files is followed by what the rows are, not by
which files are new. A batch that is run again after a failure has the same
two ids and reads the same rows.

The driver reads footers only (each file once; files do not change): the
statistics of the id column give the latest id and the row groups that a range
touches, and those are packed into partitions by their numbers of rows. The
executors read just these row groups.

Rows must arrive with ids above all earlier ones, and a writer's files count
only once its job is done: those not newer than the folder's ``_SUCCESS`` mark
(one writing job at a time). ``require_mark`` = false takes every file.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .folder import list_files, open_folder

FORMAT = "reading_table_by_id"
BEFORE_ALL = -(1 << 63)
PARTITION_ROWS = 1 << 20
BATCH_ROWS = 1 << 16


@dataclass
class IdRange(InputPartition):
    """Rows with ``after`` < id <= ``until`` of some row groups of some files."""
    groups: list[tuple[str, list[int]]]
    after: int
    until: int


def read_ranges(uri: str, part: IdRange, fields: list[tuple[str, pa.DataType]]) -> Iterator[pa.RecordBatch]:
    """The rows of a partition; a column that a file lacks is null."""
    files, _ = open_folder(uri)
    for path, groups in part.groups:
        with pq.ParquetFile(files.open_input_file(path)) as f:
            has = [name for name, _ in fields if name in f.schema_arrow.names]
            for batch in f.iter_batches(BATCH_ROWS, row_groups=groups, columns=has):
                ids = batch.column("id")
                rows = batch.filter(pc.and_(pc.greater(ids, part.after), pc.less_equal(ids, part.until)))
                if rows.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(n).cast(t) if n in has else pa.nulls(rows.num_rows, t) for n, t in fields],
                        names=[n for n, _ in fields])


class IdStreamReader(DataSourceStreamReader):
    def __init__(self, fields: list[tuple[str, pa.DataType]], options: dict[str, str]):
        self.fields, self.uri = fields, options["path"]
        self.after = int(options.get("after", BEFORE_ALL))
        self.rows = int(options.get("partition_rows", PARTITION_ROWS))
        self.require_mark = options.get("require_mark", "true").lower() != "false"
        self.footers: dict[str, list[tuple[int, int, int, int]]] = {}

    def _groups(self) -> dict[str, list[tuple[int, int, int, int]]]:
        """(row group, least id, largest id, rows) of each finished file."""
        files, root = open_folder(self.uri)
        found = list_files(files, root, ".parquet")
        if self.require_mark:
            mark = files.get_file_info(f"{root}/_SUCCESS").mtime_ns
            found = [f for f in found if mark is not None and f.mtime_ns <= mark]
        for path in [f.path for f in found if f.path not in self.footers]:
            with pq.ParquetFile(files.open_input_file(path)) as f:
                at, groups = f.schema_arrow.names.index("id"), []
                for i in range(f.num_row_groups):
                    group = f.metadata.row_group(i)
                    stats = group.column(at).statistics
                    if stats is not None and stats.has_min_max:
                        groups.append((i, stats.min, stats.max, group.num_rows))
                    elif (ids := pc.min_max(f.read_row_group(i, ["id"]).column("id")))["max"].is_valid:    # no statistics
                        groups.append((i, ids["min"].as_py(), ids["max"].as_py(), group.num_rows))
                self.footers[path] = groups
        return {f.path: self.footers[f.path] for f in found}

    def initialOffset(self) -> dict:
        return {"id": self.after}

    def latestOffset(self) -> dict:
        return {"id": max((g[2] for groups in self._groups().values() for g in groups), default=self.after)}

    def partitions(self, start: dict, end: dict) -> list[IdRange]:
        parts: list[IdRange] = []
        room = 0
        for path, groups in self._groups().items():
            for i, least, most, rows in groups:
                if most <= start["id"] or least > end["id"]:
                    continue
                if room <= 0:
                    parts.append(IdRange([], start["id"], end["id"]))
                    room = self.rows
                held = parts[-1].groups
                if not held or held[-1][0] != path:
                    held.append((path, []))
                held[-1][1].append(i)
                room -= rows
        return parts or [IdRange([], start["id"], end["id"])]

    def read(self, partition: IdRange) -> Iterator[pa.RecordBatch]:
        return read_ranges(self.uri, partition, self.fields)


class ReadingTableById(DataSource):
    """``spark.readStream.format("reading_table_by_id").option("path", table)``; options
    ``after`` (first offset), ``partition_rows``, ``require_mark``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        from .table import TABLE_SCHEMA
        return TABLE_SCHEMA

    def streamReader(self, schema) -> IdStreamReader:
        kinds = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
        return IdStreamReader([(f.name, kinds[f.dataType.simpleString()]) for f in schema.fields], dict(self.options))
