"""A stream of what happens to the files of a folder: added, changed, deleted."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from docloom.sources.files import SUFFIXES
from docloom.sources.record_files import file_system

#: Listings that stay: a batch that is run again after a failure asks for those of the last two offsets.
KEEP = 4


class FolderChanges(DataSource):
    """Options: path, the folder; state, a folder for listings that all tasks see; suffixes; tasks; content."""

    @classmethod
    def name(cls) -> str:
        return "docloom_changes"

    def schema(self) -> str:
        content = ", content binary" if self.options.get("content") == "true" else ""
        return f"path string, change string, size_bytes long, modified_ts timestamp{content}"

    def streamReader(self, schema) -> ChangeReader:
        return ChangeReader(self.options)


@dataclass
class Share(InputPartition):
    """What one task compares: the paths whose hash is this."""

    start: int
    end: int
    share: int
    shares: int


class ChangeReader(DataSourceStreamReader):
    """Offsets are numbers of listings, each a file of the state folder with a line (path, size, time) a file.

    A new listing is written when it differs from the last, so an offset stays a number however many files there are.
    Tasks compare two listings, each for its share of the paths. A query that starts again from its checkpoint goes on from
    the listing that it had reached: what happened while it was down comes with its first batch, once.
    """

    def __init__(self, options):
        self.root, self.state = options["path"].rstrip("/"), options["state"].rstrip("/")
        self.suffixes = tuple(s.lower() for s in options.get("suffixes", ",".join(SUFFIXES)).split(",") if s)
        self.tasks, self.content = int(options.get("tasks", "8")), options.get("content") == "true"

    def initialOffset(self) -> dict:
        return {"listing": 0}

    def latestOffset(self) -> dict:
        held = self._numbers()
        last = held[-1] if held else 0
        now = self._list()
        if now != (self._read(last) if last else {}):
            last += 1
            self._write(last, now)
        return {"listing": last}

    def partitions(self, start: dict, end: dict) -> list[Share]:
        n = 0 if start["listing"] == end["listing"] else self.tasks
        return [Share(start["listing"], end["listing"], k, n) for k in range(n)]

    def read(self, partition: Share) -> Iterator[tuple]:
        mine = lambda path: zlib.crc32(path.encode()) % partition.shares == partition.share
        before, after = (self._read(n, mine) if n else {} for n in (partition.start, partition.end))
        for path in sorted(before.keys() | after.keys()):
            if before.get(path) == after.get(path):
                continue
            change = "added" if path not in before else "changed" if path in after else "deleted"
            size, at = after.get(path, (None, None))
            when = None if at is None else datetime.fromtimestamp(at / 1e9, UTC).replace(tzinfo=None)
            yield (path, change, size, when, *([self._bytes(path, change)] if self.content else []))

    def commit(self, end: dict) -> None:
        for n in self._numbers():
            if n <= end["listing"] - KEEP:
                fs, path = file_system(self.state)
                fs.delete_file(f"{path}/{n:012d}.jsonl")

    def _list(self) -> dict:
        from pyarrow.fs import FileSelector, FileType

        fs, path = file_system(self.root)
        found = fs.get_file_info(FileSelector(path, recursive=True, allow_not_found=True))
        hidden = re.compile(r"(^|/)[._]")
        files = [f for f in found if f.type == FileType.File and not hidden.search(f.path[len(path) :])]
        return {f.path: (f.size, f.mtime_ns) for f in files if not self.suffixes or f.path.lower().endswith(self.suffixes)}

    def _numbers(self) -> list[int]:
        from pyarrow.fs import FileSelector

        fs, path = file_system(self.state)
        names = [f.base_name for f in fs.get_file_info(FileSelector(path, allow_not_found=True))]
        return sorted(int(n[:12]) for n in names if re.fullmatch(r"\d{12}\.jsonl", n))

    def _read(self, number: int, mine=lambda path: True) -> dict:
        fs, path = file_system(self.state)
        out = {}
        with fs.open_input_stream(f"{path}/{number:012d}.jsonl") as file:
            rest = b""
            while block := file.read(1 << 20):
                *lines, rest = (rest + block).split(b"\n")
                for line in lines:
                    name, size, at = json.loads(line)
                    if mine(name):
                        out[name] = (size, at)
        return out

    def _write(self, number: int, listing: dict) -> None:
        fs, path = file_system(self.state)
        fs.create_dir(path, recursive=True)
        with fs.open_output_stream(f"{path}/_{number}") as out:
            for name, (size, at) in listing.items():
                out.write(json.dumps([name, size, at]).encode() + b"\n")
        fs.move(f"{path}/_{number}", f"{path}/{number:012d}.jsonl")

    def _bytes(self, path: str, change: str) -> bytes | None:
        """None if the file is gone, by its change or since it was listed."""
        if change == "deleted":
            return None
        fs, _ = file_system(self.root)
        try:
            with fs.open_input_stream(path) as file:
                return file.read()
        except FileNotFoundError:
            return None


def watch_changes(
    spark: SparkSession, root: str, state: str, suffixes: tuple[str, ...] = SUFFIXES, tasks: int = 8, content: bool = False
) -> DataFrame:
    """(path, change, size_bytes, modified_ts[, content]) of files below root, suffixes in any case.

    change: added, changed (size or time) or deleted, each seen once for each difference between two listings. state is
    a folder of the query's own, beside its checkpoint, that driver and executors see. Files and folders that begin
    with a dot or an underscore are left out.
    """
    spark.dataSource.register(FolderChanges)
    reader = spark.readStream.format(FolderChanges.name()).option("path", root).option("state", state)
    return reader.option("suffixes", ",".join(suffixes)).option("tasks", str(tasks)).option("content", str(content).lower()).load()


def current_files(changes: DataFrame, key: str = "path") -> DataFrame:
    """The files that are there after all changes of a table of events with a column batch: the last event of each, unless deleted."""
    from docloom.sources.record_files import last_of_each

    return last_of_each(changes, key, "batch").where("change <> 'deleted'")
