"""Large text files read in byte ranges that end where a pretoken surely ends.

A file is cut into ranges of equal size. The edge of a range moves on to the next safe
place, so the pretokens of the pieces are exactly those of the whole file. Inside a range,
rows are cut at safe places as well and stay small. A task reads one range, or as many small
ones as a caller allows; rows are handed on in batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tokenloom.functions import arrays, text as tx
from tokenloom.operators.pretokens import pretoken_spans

SCHEMA = "path string, start long, text string"
RANGE_BYTES, ROW_BYTES = 32 << 20, 1 << 20
#: Bytes of the rows a task hands on at once.
BATCH_BYTES = 1 << 20
#: Bytes searched at once for an edge; bytes seen before and after a place.
SCANNED, BEHIND, AHEAD = 1 << 14, 4, 2
#: A pretoken ends before a single space between two printed ASCII characters, and after
#: a line feed between two characters that are no white space: ASCII, or those whose first
#: byte has no white space in its block.
PRETOKEN_EDGE = re.compile(
    rb"(?<=[!-~])(?= [!-~])"
    rb"|(?:(?<=[!-~]\n)|(?<=[\xe4-\xed][\x80-\xbf]{2}\n))(?=[!-~\xc3-\xdf\xe4-\xed])"
)
LINE_EDGE = re.compile(rb"(?<=\n)")
EDGES = {"pretoken": PRETOKEN_EDGE, "line": LINE_EDGE}


def next_edge(file: pa.NativeFile, size: int, at: int, edge: re.Pattern) -> int:
    """The first safe place at or after ``at``; the end of the file if there is none."""
    while at < size:
        low = max(0, at - BEHIND)
        data = file.read_at(at - low + SCANNED + AHEAD, low)
        found = edge.search(data, at - low)
        if found and found.start() + low < at + SCANNED:
            return found.start() + low
        at += SCANNED
    return size


def range_rows(
    file: pa.NativeFile, size: int, begin: int, end: int, edge: re.Pattern, row_bytes: int
) -> Iterator[tuple[int, bytes]]:
    """(start, bytes) of the rows of a range; without a safe place inside it has none."""
    start = begin if begin == 0 else next_edge(file, size, begin, edge)
    while start < min(end, size):
        stop = next_edge(file, size, max(start + 1, min(start + row_bytes, end)), edge)
        yield start, file.read_at(stop - start, start)
        start = stop


@dataclass
class ByteRanges(InputPartition):
    """(path, size, begin, end) of the ranges that one task reads."""

    ranges: list[tuple[str, int, int, int]]


class RangeReader(DataSourceReader):
    """Plans the ranges of all files below a path and reads some per task."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.range_bytes = int(options.get("rangebytes", RANGE_BYTES))
        self.row_bytes = int(options.get("rowbytes", ROW_BYTES))
        self.task_bytes = int(options.get("taskbytes", 0))
        self.edge = options.get("edge", "pretoken")
        if self.edge not in EDGES or min(self.range_bytes, self.row_bytes) < 1:
            raise ValueError("edge must be 'pretoken' or 'line', sizes positive")

    def partitions(self) -> list[ByteRanges]:
        tasks, held = [ByteRanges([])], 0
        for path, size in sorted(text_files(self.path)):
            for begin in range(0, size, self.range_bytes):
                end = min(begin + self.range_bytes, size)
                if held and held + end - begin > self.task_bytes:
                    tasks.append(ByteRanges([]))
                    held = 0
                tasks[-1].ranges.append((path, size, begin, end))
                held += end - begin
        return tasks

    def read(self, partition: ByteRanges) -> Iterator[pa.RecordBatch]:
        paths, starts, texts, held = [], [], [], 0
        for path, ranges in groupby(partition.ranges, key=lambda x: x[0]):
            system, name = file_system(path)
            with system.open_input_file(name) as file:
                for _, size, begin, end in ranges:
                    for start, data in range_rows(
                        file, size, begin, end, EDGES[self.edge], self.row_bytes
                    ):
                        if held and held + len(data) > BATCH_BYTES:
                            yield _batch(paths, starts, texts)
                            paths, starts, texts, held = [], [], [], 0
                        paths.append(path)
                        starts.append(start)
                        texts.append(data.decode("utf-8"))
                        held += len(data)
        if paths:
            yield _batch(paths, starts, texts)


def _batch(paths: list[str], starts: list[int], texts: list[str]) -> pa.RecordBatch:
    columns = [pa.array(paths, pa.string()), pa.array(starts, pa.int64()), pa.array(texts, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["path", "start", "text"])


class RangeSource(DataSource):
    """``text_ranges``: path, rangeBytes, rowBytes, taskBytes, edge ('pretoken' or 'line')."""

    @classmethod
    def name(cls) -> str:
        return "text_ranges"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> RangeReader:
        return RangeReader({name.lower(): value for name, value in self.options.items()})


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and its name there."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path[len("file:") :])
    return fs.LocalFileSystem(), path


def text_files(path: str) -> list[tuple[str, int]]:
    """(path, size) of the files at or below a path; hidden ones and markers are left out."""
    system, name = file_system(path)
    root = path[: len(path) - len(name)] if path.endswith(name) else ""
    info = system.get_file_info(name)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else system.get_file_info(fs.FileSelector(name, recursive=True))
    return [
        (root + x.path, x.size)
        for x in found
        if x.is_file and not any(part.startswith(("_", ".")) for part in x.path[len(name) :].split("/"))
    ]


def read_ranges(
    spark: SparkSession,
    path: str,
    range_bytes: int = RANGE_BYTES,
    row_bytes: int = ROW_BYTES,
    edge: str = "pretoken",
    task_bytes: int = 0,
) -> DataFrame:
    """Text files of any size: (path, start, text), ``start`` the byte where a row begins.

    Rows of a file follow each other without gap or overlap. The pretokens of the rows are
    those of the whole file, however it is cut; specials with white space inside are not
    kept whole. A stretch without any safe place becomes one row. Paths are those of Arrow
    file systems; malformed UTF-8 fails. Where files or ranges are small, one task reads as
    many ranges as ``task_bytes`` hold.
    """
    spark.dataSource.register(RangeSource)
    reader = spark.read.format(RangeSource.name()).option("edge", edge).option("taskBytes", task_bytes)
    return reader.option("rangeBytes", range_bytes).option("rowBytes", row_bytes).load(path)


def file_spans(rows: DataFrame, least: int = 1) -> DataFrame:
    """Byte spans of all pretokens of files read by ranges: (path, pretoken, start, end)."""
    place = F.struct("path", F.col("start").alias("base")).alias("place")
    spans = pretoken_spans(rows.select(place, "text"), key="place", least=least)
    base = F.col("place.base")
    return spans.select(
        "place.path", "pretoken", (base + F.col("start")).alias("start"), (base + F.col("end")).alias("end")
    )


def range_lines(
    spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, task_bytes: int = 0
) -> DataFrame:
    """Lines of text files with their newline: (path, start, text); ``start`` in bytes."""
    rows = read_ranges(spark, path, range_bytes, edge="line", task_bytes=task_bytes)
    cut = rows.select("path", "start", F.array_remove(F.split("text", r"(?<=\n)"), "").alias("lines"))
    sizes = F.transform("lines", lambda x: F.octet_length(x).cast("bigint"))
    ends = arrays.prefix_sums(sizes, F.lit(0).cast("bigint"))
    paired = F.arrays_zip(F.col("lines"), ends.alias("ends"))
    each = cut.select("path", "start", F.explode(paired).alias("line"))
    begin = F.col("start") + F.col("line.ends") - F.octet_length("line.lines")
    return each.select("path", begin.alias("start"), F.col("line.lines").alias("text"))
