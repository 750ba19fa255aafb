"""Streaming scan of text files that still grow: every line once it is complete, with its place.

Spark's own file source reads a path once and forgets it. This one keeps how many bytes of each file it has
read, as the stream's offset, so lines that are appended later come with a later batch, and
a restart goes on where the last committed batch ended. A line counts when its line end is there; the last
line of a file that has not changed for ``quiet_seconds`` counts without one.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

LINES = "file string, offset bigint, value string"
#: Bytes read at once, and the largest part of a file that one task reads.
CHUNK = 1 << 16
PART = 1 << 27


def _filesystem(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _last_line_end(filesystem, path: str, start: int, size: int) -> int:
    """Bytes up to and with the last line end of ``[start, size)``; ``start`` where there is none."""
    with filesystem.open_input_file(path) as f:
        at = size
        while at > start:
            low = max(start, at - CHUNK)
            found = f.read_at(at - low, low).rfind(b"\n")
            if found >= 0:
                return low + found + 1
            at = low
    return start


class _Part(InputPartition):
    def __init__(self, path: str, start: int, end: int, file_end: int) -> None:
        self.path, self.start, self.end, self.file_end = path, start, end, file_end


class _TailReader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.folder = options["path"]
        self.suffix = options.get("suffix", "")
        self.quiet = float(options.get("quiet_seconds", 60))
        self.seen: dict[str, int] = {}
        self.known: dict[str, tuple[int, int]] = {}

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def latestOffset(self) -> dict:
        from pyarrow import fs

        filesystem, root = _filesystem(self.folder)
        for info in filesystem.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            name = info.path.rsplit("/", 1)[-1]
            if not info.is_file or not name.endswith(self.suffix) or name.startswith((".", "_")):
                continue
            quiet = time.time() - info.mtime_ns / 1e9 >= self.quiet
            state = (info.size, int(quiet))
            if self.known.get(info.path) != state and info.size:
                # only files that changed are looked at, from their end
                done = self.seen.get(info.path, 0)
                end = info.size if quiet else _last_line_end(filesystem, info.path, done, info.size)
                self.known[info.path] = state
                if end:
                    self.seen[info.path] = max(done, end)
        return {"files": json.dumps(self.seen, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        before, after = json.loads(start["files"]), json.loads(end["files"])
        self.seen = {**after, **{k: max(v, after.get(k, 0)) for k, v in self.seen.items()}}
        parts = []
        for path, stop in after.items():
            for at in range(before.get(path, 0), stop, PART):
                parts.append(_Part(path, at, min(at + PART, stop), stop))
        return parts

    def read(self, partition: _Part) -> Iterator[tuple]:
        """Lines that start inside the part; the last one may end behind it."""
        filesystem, _ = _filesystem(self.folder)
        with filesystem.open_input_file(partition.path) as f:
            at = partition.start
            if at > 0 and f.read_at(1, at - 1) != b"\n":
                at = self._next_line(f, at, partition.file_end)
            rest, place = b"", at
            while at < partition.file_end and place < partition.end:
                data = f.read_at(min(CHUNK, partition.file_end - at), at)
                at += len(data)
                lines = (rest + data).split(b"\n")
                rest = lines.pop()
                for line in lines:
                    if place >= partition.end:
                        return
                    yield partition.path, place, line.rstrip(b"\r").decode("utf-8", "replace")
                    place += len(line) + 1
            if rest and place < partition.end:
                yield partition.path, place, rest.rstrip(b"\r").decode("utf-8", "replace")

    def _next_line(self, f, at: int, end: int) -> int:
        while at < end:
            data = f.read_at(min(CHUNK, end - at), at)
            found = data.find(b"\n")
            if found >= 0:
                return at + found + 1
            at += len(data)
        return end


class TailSource(DataSource):
    """Option ``path`` is a folder, ``suffix`` the end of the wanted file names."""

    @classmethod
    def name(cls) -> str:
        return "tail_lines"

    def schema(self) -> str:
        return LINES

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _TailReader(self.options)


def tail_lines(spark: SparkSession, folder: str, suffix: str = "", quiet_seconds: float = 60.0) -> DataFrame:
    """Stream of ``(file, offset, value)``: complete lines of all files below a folder, as they are written."""
    spark.dataSource.register(TailSource)
    reader = spark.readStream.format("tail_lines").option("suffix", suffix).option("quiet_seconds", quiet_seconds)
    return reader.load(folder)
