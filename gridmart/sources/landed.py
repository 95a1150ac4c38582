"""A streaming source of landed documents that remembers days, not files.

Its offset holds one number for each day folder: when it last changed. A trigger lists the
root, and the folders that have changed since; so neither what is remembered nor what is
listed grows with the files of the archive. All documents of a changed day are handed out
again, so a late, old or repeated fetch meets the others of its day in one batch, and the
newest of them wins whatever the order in which they came.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

DAY_FOLDER = "delivery_date="

# Files and bytes that a task reads, and bytes of a batch it hands on.
TASK_FILES = 256
TASK_BYTES = 64 << 20
BATCH_BYTES = 8 << 20

# Workers get the source with the plan, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class LandedDocuments(DataSource):
    """Whole documents below ``<root>/delivery_date=<day>/`` with their landing times.

    Option ``root``: the archive, a path or the address of any store that pyarrow opens.
    """

    @classmethod
    def name(cls) -> str:
        return "landed_documents"

    def schema(self) -> str:
        return "document string, delivery_date date, landed_at timestamp, path string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LandedReader(self.options["root"])


class Files(InputPartition):
    """Some documents: (day, path, landing time in milliseconds)."""

    def __init__(self, files: list[tuple[str, str, int]]):
        super().__init__(files)


def opened(root: str) -> tuple[fs.FileSystem, str, str]:
    """The store, the root in it, and what goes before its paths in an address."""
    if "://" not in root:
        return fs.LocalFileSystem(), root.removeprefix("file:").rstrip("/"), "file:"
    store, path = fs.FileSystem.from_uri(root)
    path = path.rstrip("/")
    return store, path, root.rstrip("/").removesuffix(path)


def _hidden(info: fs.FileInfo) -> bool:
    return info.base_name.startswith(("_", "."))


def _changed(store: fs.FileSystem, folder: fs.FileInfo) -> int:
    """When the folder last changed, in nanoseconds; stores without folders say it of files."""
    if folder.mtime_ns is not None and folder.mtime_ns > 0:
        return folder.mtime_ns
    files = store.get_file_info(fs.FileSelector(folder.path))
    newest = max((file.mtime_ns or 0 for file in files), default=0)
    return newest + len(files)


class LandedReader(DataSourceStreamReader):
    def __init__(self, root: str):
        self.root = root

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """When each day folder last changed."""
        store, root, _ = opened(self.root)
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        days = {}
        for folder in found:
            name = folder.base_name
            if folder.type == fs.FileType.Directory and name.startswith(DAY_FOLDER):
                days[name.removeprefix(DAY_FOLDER)] = _changed(store, folder)
        return days

    def partitions(self, start: dict, end: dict) -> list[Files]:
        """The documents of the days that changed, a bounded number to a task."""
        store, root, before = opened(self.root)
        tasks: list[list] = []
        size = 0
        for day in sorted(day for day in end if start.get(day) != end[day]):
            folder = f"{root}/{DAY_FOLDER}{day}"
            found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
            for file in sorted(found, key=lambda info: info.path):
                if file.type != fs.FileType.File or _hidden(file):
                    continue
                if not tasks or len(tasks[-1]) == TASK_FILES or size + file.size > TASK_BYTES:
                    tasks.append([])
                    size = 0
                size += file.size
                tasks[-1].append((day, before + file.path, file.mtime_ns // 1_000_000))
        return [Files(files) for files in tasks]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _, before = opened(self.root)
        rows: list[tuple] = []
        size = 0
        for day, path, landed in partition.value:
            with store.open_input_stream(path.removeprefix(before)) as stream:
                text = stream.read()
            rows.append((text.decode("utf-8", "replace"), day, landed, path))
            size += len(text)
            if size >= BATCH_BYTES:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    texts, days, landed, paths = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(texts, pa.string()),
            pa.array([dt.date.fromisoformat(day) for day in days], pa.date32()),
            pa.array([time * 1000 for time in landed], pa.timestamp("us", tz="UTC")),
            pa.array(paths, pa.string()),
        ],
        names=["document", "delivery_date", "landed_at", "path"],
    )
