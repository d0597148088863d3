"""Streaming line files with positions and a record cap.

Spark's own file stream hands out whole files without line positions. This
source's offset is a place in the file order: files by natural name, then the
byte. So a stream has the order of the lines (``offset`` is file number and
byte in one long; ``ingest_ts`` is when the file was last written), a
micro-batch ends in the middle of a file after at most
``max_records`` lines, and a query goes on from there, also in files that
have grown.

Planning a micro-batch looks for the end of its last line, so the planner
reads the next ``max_records`` lines at most; the tasks read the byte ranges
that the batch is cut into and start at line ends.

Files are read through ``pyarrow.fs`` (local paths and the stores it knows).
A new file must sort after the ones already read: one that comes before them
is an error, not silently lost. A last line without a line end waits until
the file goes on or another file follows; ``unterminated="read"`` takes it.
Spark asks such a source for its latest place without saying where the query
is, so the planned places are kept in ``progress``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..schema import ORDER_COL

MAX_RECORDS = 100_000
FILE_SHIFT = 40  # a file has less than 2^40 bytes
PIECE = 1 << 22  # bytes read at once
TASK_BYTES = 1 << 20
SCHEMA = f"{ORDER_COL} long, value string, ingest_ts timestamp"


def natural_key(name: str) -> list:
    """Digit runs as numbers, as ``sources.text.natural_name`` orders."""
    import re

    return [(0, int(x), "") if x.isdigit() else (1, 0, x) for x in re.findall(r"\d+|\D+", name)]


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class Range(InputPartition):
    """Lines that begin in bytes ``start`` to ``stop`` of a file."""

    def __init__(self, number: int, path: str, start: int, stop: int, first: bool, written: datetime | None = None):
        self.number, self.path, self.start, self.stop, self.first = number, path, start, stop, first
        self.written = written


def line_stops(f, start: int, stop: int) -> Iterator[np.ndarray]:
    """Places behind the line ends of a byte range, piece by piece."""
    f.seek(start)
    at = start
    while at < stop:
        raw = np.frombuffer(f.read(min(PIECE, stop - at)), np.uint8)
        if not len(raw):
            return
        yield at + 1 + np.flatnonzero(raw == 10)
        at += len(raw)


def read_range(r: Range) -> Iterator[pa.RecordBatch]:
    """offset and value of the lines of a range; line ends are \\n or \\r\\n."""
    fs, path = opened(r.path)
    with fs.open_input_file(path) as f:
        size = f.size()
        start = r.start
        if not r.first:  # in the middle of a line, unless the byte before ends one
            start = next((int(s[0]) for s in line_stops(f, r.start - 1, size) if len(s)), size)
        while start < r.stop:
            f.seek(start)
            raw = f.read(PIECE)
            upto = raw.rfind(b"\n") + 1
            while not upto and start + len(raw) < size:  # a line longer than a piece
                raw += f.read(PIECE)
                upto = raw.rfind(b"\n") + 1
            if not upto:
                upto = len(raw)  # the end of the file
            lines = raw[:upto].split(b"\n")
            if raw[:upto].endswith(b"\n"):
                lines.pop()
            at = start + np.concatenate([[0], np.cumsum([len(x) + 1 for x in lines])])[:len(lines)]
            own = int(np.searchsorted(at, r.stop))
            text = [x.removesuffix(b"\r").decode("utf-8", "replace") for x in lines[:own]]
            yield pa.RecordBatch.from_pydict({ORDER_COL: pa.array((r.number << FILE_SHIFT) + at[:own], pa.int64()),
                                              "value": pa.array(text, pa.string()),
                                              "ingest_ts": pa.array([r.written] * own, pa.timestamp("us", tz="UTC"))})
            if own < len(lines):
                return
            start += upto


class LineFilesReader(DataSourceStreamReader):
    def __init__(self, path: str, progress: str, max_records: int, unterminated: str, tasks: int):
        self.path, self.progress, self.max_records = path.rstrip("/"), progress.rstrip("/"), max_records
        self.unterminated, self.tasks = unterminated, tasks
        self.last: dict | None = None

    # --- places ------------------------------------------------------------

    def _files(self) -> list[tuple[str, int, datetime]]:
        """name, size and time of the files, in order."""
        fs, root = opened(self.path)
        found = [(i.base_name, i.size, i.mtime) for i in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
                 if i.is_file and i.base_name[0] not in "._"]
        return sorted(found, key=lambda x: natural_key(x[0]))

    def _kept(self) -> dict | None:
        fs, root = opened(self.progress)
        names = [i.base_name for i in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if i.is_file]
        if not names:
            return None
        with fs.open_input_stream(f"{root}/{max(names)}") as f:
            return json.loads(f.read())

    def _keep(self, place: dict) -> None:
        fs, root = opened(self.progress)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{place['number']:012d}-{place['byte']:020d}") as f:
            f.write(json.dumps(place).encode())

    def initialOffset(self) -> dict:
        return {"file": "", "number": 0, "byte": 0}

    def latestOffset(self) -> dict:
        here = self.last or self._kept() or self.initialOffset()
        self.last = self._ahead(here)
        return self.last

    def _checked(self, place: dict, files: list[tuple[str, int, datetime]]) -> None:
        if place["file"] and [f[0] for f in files].index(place["file"]) != place["number"]:
            raise ValueError(f"a file came before {place['file']}, which is read already")

    def _ahead(self, here: dict) -> dict:
        """The place up to ``max_records`` lines after ``here``."""
        files, left = self._files(), self.max_records
        self._checked(here, files)
        fs, root = opened(self.path)
        place = here
        for k in range(here["number"], len(files)):
            name, size, _ = files[k]
            start = here["byte"] if k == here["number"] else 0
            whole = k + 1 < len(files) or self.unterminated == "read"  # a rest without a line end is a line
            stop = start
            with fs.open_input_file(f"{root}/{name}") as f:
                for ends in line_stops(f, start, size):
                    if len(ends):
                        stop = int(ends[min(left, len(ends)) - 1])
                        left -= min(left, len(ends))
                    if not left:
                        break
            if left and whole and stop < size:
                stop, left = size, left - 1
            place = {"file": name, "number": k, "byte": stop}
            if not left:
                break
        return place

    def partitions(self, start: dict, end: dict) -> list[Range]:
        files = self._files()
        self.last = end if self.last is None else self.last
        out = []
        for k in range(start["number"], end["number"] + 1 if end["file"] else 0):
            name, size, written = files[k]
            a = start["byte"] if k == start["number"] else 0
            b = end["byte"] if k == end["number"] else size
            step = max(TASK_BYTES, -(-(b - a) // self.tasks))
            out += [Range(k, f"{self.path}/{name}", at, min(at + step, b), at == a, written)
                    for at in range(a, b, step)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return read_range(partition)

    def commit(self, end: dict) -> None:
        self._keep(end)


class LineFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tollstream_lines"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LineFilesReader:
        o = self.options
        return LineFilesReader(o["path"], o["progress"], int(o.get("max_records", MAX_RECORDS)),
                               o.get("unterminated", "wait"), int(o.get("tasks", 8)))


def read_line_stream(spark: SparkSession, path: str, progress: str, max_records: int = MAX_RECORDS,
                     unterminated: str = "wait") -> DataFrame:
    """``offset``, ``value`` and ``ingest_ts`` of the lines under ``path``, at
    most ``max_records`` a micro-batch. Spark gives such a source one
    micro-batch under ``availableNow``: run it with a processing time trigger
    and ``processAllAvailable``. ``progress``: a folder of this query's
    own, kept with its checkpoint."""
    import sys

    from pyspark import cloudpickle

    from ..session import ship_code, task_slots
    ship_code(spark)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the planner may lack this package
    spark.dataSource.register(LineFiles)
    return (spark.readStream.format("tollstream_lines").option("path", path).option("progress", progress)
            .option("max_records", str(max_records)).option("unterminated", unterminated)
            .option("tasks", str(task_slots(spark))).load())
