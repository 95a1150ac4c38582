"""Parquet tables partitioned by local delivery day."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from gridmart.operators.keys import merge_rows
from gridmart.schemas import (
    DAY,
    GENERATION_HOUR_KEY,
    GENERATION_KEY,
    HOUR_KEY,
    HOUR_STATE,
    HOURLY_GENERATION,
    HOURLY_PRICES,
    PRICE_KEY,
    RAW_GENERATION,
    RAW_PRICES,
    column_names,
    column_types,
)

# What the log holds of every file: its place, key range and the commit that listed it.
_RANGE = "rows bigint, low struct<{key}>, high struct<{key}>, born int, commit bigint, source bigint"

# Every so many commits one lists all days, so that readers need no older ones.
_WHOLE_EVERY = 10
_WHOLE = "-whole"

_ATTEMPTS = 5
_VERSION = "version"


class ConcurrentWrite(RuntimeError):
    """Another writer committed first."""


@dataclass(frozen=True)
class DayTable:
    """A table at ``path`` with a declared schema and a business key that ends in an instant.

    Files lie below ``<path>/version=<write>/delivery_date_local=<day>/`` and are never
    changed. Which of them make up a day is said by the log at ``<path>_commits``: a commit
    lists all files of the days it touches, with the least and greatest key of each. Its
    folder gets its number by one rename that fails if the number is taken. So a reader
    sees each write as a whole or not at all, keeps the files it began with until
    ``vacuum``, and of two writers the later one starts over.
    """

    spark: SparkSession
    path: str
    schema: str
    key: list[str]
    rows_per_file: int = 1 << 22

    def create_if_absent(self) -> None:
        """An empty table of the declared shape, unless there already is a table."""
        if not self.commits():
            try:
                self._commit(None, self.spark.createDataFrame([], self._record))
            except ConcurrentWrite:
                pass

    def read(self) -> DataFrame:
        """The rows as of the last commit, whatever is written while they are read."""
        return self._rows(self._places(self.files()))

    @property
    def columns(self) -> list[str]:
        return column_names(self.schema)

    def read_days(self, days: Iterable[dt.date]) -> DataFrame:
        """The rows of some days, whose files alone are looked at."""
        return self._rows(self._places(self.files(days)))

    def stage(self, batch: DataFrame) -> tuple[str, DataFrame]:
        """Write the batch to a folder of its own; the folder, and the rows read from there.

        What follows (checks, match, write) reads stored rows, so a lost executor
        never makes Spark parse the documents again.
        """
        folder = f"{self.path}_staging/{uuid.uuid4().hex}"
        batch.write.parquet(folder)
        return folder, self.spark.read.schema(batch.schema).parquet(folder)

    def replace_days(self, rows: DataFrame, source: int | None = None) -> None:
        """Replace exactly the days that occur in ``rows``, which may be read from the table."""
        written = self._write(rows)
        for _ in range(_ATTEMPTS):
            try:
                return self._commit(self.last(), written, source)
            except ConcurrentWrite:
                continue
        raise ConcurrentWrite(self.path)

    def merge(
        self, batch: DataFrame, gone: DataFrame | None = None, source: int | None = None
    ) -> None:
        """Put the rows of ``batch``, of unique keys without nulls, in place of those with their
        keys, and leave out those with the keys of ``gone``, which holds days and keys.

        Only files whose key range may hold such a key are read and written anew; the
        others of these days stay as they are. Both should be stored: they are read several
        times. ``source`` is noted with the commit, for tables made from another one.
        """
        places = [DAY, *self.key]
        touched = batch.select(*places)
        if gone is not None:
            touched = touched.union(gone.select(*places))
        days = listed_days(touched)
        if not days:
            return
        for _ in range(_ATTEMPTS):
            base = self.last()
            files = self.files(days, base)
            met = self._met(files, touched).collect()
            old = self._rows(met)
            if gone is not None:
                old = old.join(gone.select(*self.key), self.key, "left_anti")
            rows = merge_rows(old, batch.select(*self.columns), self.key)
            written = self._write(rows if met else batch)
            known = self.spark.createDataFrame(met, files.select(*self._place, "born").schema)
            kept = files.join(known, self._place, "left_anti")
            try:
                return self._commit(base, kept.unionByName(written), source)
            except ConcurrentWrite:
                continue
        raise ConcurrentWrite(self.path)

    def _met(self, files: DataFrame, batch: DataFrame) -> DataFrame:
        """The files whose key range meets the batch.

        The batch is first reduced to the span of its instants in each hour of a series, a
        partial aggregate, and the files are those of its days: the join is on the day.
        """
        *series, instant = self.key
        spans = batch.groupBy(DAY, *series, F.date_trunc("hour", instant).alias("_hour")).agg(
            F.min(instant).alias("_first"), F.max(instant).alias("_last")
        )
        first = F.struct(*series, F.col("_first").alias(instant))
        last = F.struct(*series, F.col("_last").alias(instant))
        spans = spans.select(DAY, first.alias("_from"), last.alias("_to"))
        met = files.join(spans, DAY).filter("low <= _to AND high >= _from")
        return met.select(*self._place, "born").distinct()

    @property
    def _place(self) -> list[str]:
        return [DAY, _VERSION, "file"]

    @property
    def _record(self) -> str:
        types = column_types(self.schema)
        key = ", ".join(f"{name}: {types[name]}" for name in self.key)
        return f"{DAY} date, {_VERSION} string, file string, {_RANGE.format(key=key)}"

    @property
    def _log(self) -> str:
        return f"{self.path}_commits"

    def commits(self) -> dict[int, str]:
        """The folders of the log by number."""
        found = {}
        if _exists(self.spark, self._log):
            files, log = _files(self.spark, self._log)
            for status in files.listStatus(log):
                name = status.getPath().getName()
                if name.removesuffix(_WHOLE).isdigit():
                    found[int(name.removesuffix(_WHOLE))] = f"{self._log}/{name}"
        return found

    def last(self) -> int | None:
        """The number of the last commit."""
        return max(self.commits(), default=None)

    def source(self) -> int | None:
        """The greatest ``source`` noted with what the table holds."""
        return self.files().agg(F.max("source")).first()[0]

    def changes(self, since: int, until: int) -> DataFrame | None:
        """Rows that a commit has and an earlier one has not, or has otherwise: ``sign`` 1 for
        those it has, -1 for those it lost. None if the files of the earlier one are gone.

        Only files that one of the two lists and the other does not are read: the rows
        rewritten as they were meet by key and drop out.
        """
        before, after = self.files(at=since), self.files(at=until)
        lost = self._places(before.join(after, self._place, "left_anti"))
        fresh = self._places(after.join(before, self._place, "left_anti"))
        paths = [f"{self._folder(row)}/{row['file']}" for row in lost]
        if since not in self.commits() or not all(_exists(self.spark, path) for path in paths):
            return None
        old, new = self._rows(lost), self._rows(fresh)
        rest = [name for name in self.columns if name not in self.key]
        both = old.select(*self.key, F.struct(*rest).alias("old")).join(
            new.select(*self.key, F.struct(*rest).alias("new")), self.key, "full_outer"
        )
        sides = [
            F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")),
            F.struct(F.lit(1).alias("sign"), F.col("new").alias("row")),
        ]
        changed = both.filter(~F.col("old").eqNullSafe(F.col("new")))
        signed = changed.select(*self.key, F.explode(F.array(*sides)).alias("side"))
        return signed.filter("side.row IS NOT NULL").select(*self.key, "side.row.*", "side.sign")

    def files(self, days: Iterable[dt.date] | None = None, at: int | None = None) -> DataFrame:
        """The files of the table, or of some days, as of a commit or the last one."""
        commits = self.commits()
        numbers = sorted(n for n in commits if at is None or n <= at)
        whole = [n for n in numbers if commits[n].endswith(_WHOLE)]
        folders = [commits[n] for n in numbers if not whole or n >= whole[-1]]
        if not folders:
            return self.spark.createDataFrame([], self._record)
        listed = self.spark.read.schema(self._record).parquet(*folders)
        if days is not None:
            listed = listed.filter(F.col(DAY).isin(list(days)))
        newest = F.max("commit").over(Window.partitionBy(DAY))
        listed = listed.withColumn("_newest", newest).filter("commit = _newest")
        return listed.drop("_newest")

    def _places(self, files: DataFrame) -> list[Row]:
        return files.select(*self._place, "born").collect()

    def _rows(self, files: list[Row]) -> DataFrame:
        """The rows of some files."""
        paths = self._paths(files)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.schema).option("basePath", self.path)
        return reader.parquet(*paths).select(*self.columns)

    def _folder(self, file: Row) -> str:
        return f"{self.path}/{_VERSION}={file[_VERSION]}/{DAY}={file[DAY].isoformat()}"

    def _paths(self, files: list[Row]) -> list[str]:
        """Paths of some files; a folder all of whose files are wanted is one path."""
        folders: dict[str, list] = {}
        for row in files:
            folders.setdefault(self._folder(row), []).append(row)
        paths = []
        for folder, rows in sorted(folders.items()):
            whole = len(rows) == rows[0]["born"]
            paths += [folder] if whole else [f"{folder}/{row['file']}" for row in rows]
        return paths

    def _write(self, rows: DataFrame) -> DataFrame:
        """Store rows as files of a new version, and list these.

        Rows are dealt by ranges of day and key, so a hot day is split over several tasks,
        and each file holds a range of keys and is sorted: time filters skip row groups.
        """
        version = uuid.uuid4().hex
        folder = f"{self.path}/{_VERSION}={version}"
        (
            rows.select(*self.columns)
            .repartitionByRange(DAY, *self.key)
            .sortWithinPartitions(DAY, *self.key)
            .write.option("maxRecordsPerFile", self.rows_per_file)
            .partitionBy(DAY)
            .parquet(folder)
        )
        if not _exists(self.spark, folder):
            return self.spark.createDataFrame([], self._record)
        # Sorted files: their first and last rows hold the range, whatever lies between.
        stored = self.spark.read.schema(self.schema).parquet(folder)
        file, at = F.col("_metadata.file_name"), F.col("_metadata.row_index")
        # A task gives its files of all days one name.
        ends = stored.groupBy(DAY, file.alias("file")).agg(F.max(at).alias("end"))
        edges = (
            stored.select(DAY, file.alias("file"), at.alias("at"), F.struct(*self.key).alias("key"))
            .join(ends, [DAY, "file"])
            .filter("at = 0 OR at = end")
        )
        listed = edges.groupBy(DAY, "file").agg(
            (F.max("end") + 1).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        born = F.count("*").over(Window.partitionBy(DAY)).cast("int")
        return listed.select(
            DAY,
            F.lit(version).alias(_VERSION),
            "file",
            "rows",
            "low",
            "high",
            born.alias("born"),
            F.lit(None).cast("long").alias("commit"),
            F.lit(None).cast("long").alias("source"),
        )

    def _commit(self, base: int | None, files: DataFrame, source: int | None = None) -> None:
        """List ``files`` as all that their days hold, as the commit after ``base``."""
        number = 0 if base is None else base + 1
        whole = number % _WHOLE_EVERY == 0
        record = files
        if whole and base is not None:
            rest = self.files(at=base).join(files.select(DAY).distinct(), DAY, "left_anti")
            record = record.unionByName(rest)
        folder = f"{self._log}/writing-{uuid.uuid4().hex}"
        if source is not None:
            record = record.withColumn("source", F.lit(source).cast("long"))
        record.withColumn("commit", F.lit(number).cast("long")).coalesce(1).write.parquet(folder)
        taken = number in self.commits()
        if taken or not _rename(self.spark, folder, f"{self._log}/{number:012d}{_WHOLE * whole}"):
            remove_folder(self.spark, folder)
            raise ConcurrentWrite(f"commit {number} of {self.path}")

    def vacuum(self, keep: int = 1, age: dt.timedelta = dt.timedelta(days=1)) -> int:
        """Delete files that none of the last ``keep`` commits lists; how many there were.

        Files younger than ``age`` stay: they may be those of a write that is still to be
        committed, or be read by a query that began before the last commits.
        """
        commits = self.commits()
        kept = sorted(commits)[-keep:]
        live = {
            (row[_VERSION], row[DAY].isoformat(), row["file"])
            for number in kept
            for row in self.files(at=number).select(*self._place).collect()
        }
        before = (dt.datetime.now() - age).timestamp() * 1000
        gone = 0
        files, root = _files(self.spark, self.path)
        found = files.listFiles(root, True) if files.exists(root) else None
        while found is not None and found.hasNext():
            status = found.next()
            path = status.getPath()
            day, version = path.getParent().getName(), path.getParent().getParent().getName()
            place = version.partition("=")[2], day.partition("=")[2], path.getName()
            if place[2].endswith(".parquet") and place not in live:
                if status.getModificationTime() <= before:
                    gone += bool(files.delete(path, False))
        whole = [n for n in commits if commits[n].endswith(_WHOLE) and n <= kept[0]] if kept else []
        for number in commits:
            if whole and number < max(whole):
                remove_folder(self.spark, commits[number])
        return gone


def generation_table(spark: SparkSession, path: str) -> DayTable:
    return DayTable(spark, path, RAW_GENERATION, GENERATION_KEY)


def price_table(spark: SparkSession, path: str) -> DayTable:
    return DayTable(spark, path, RAW_PRICES, PRICE_KEY)


def hourly_generation_table(spark: SparkSession, path: str) -> DayTable:
    return DayTable(spark, path, HOURLY_GENERATION, GENERATION_HOUR_KEY)


def hourly_price_table(spark: SparkSession, path: str) -> DayTable:
    return DayTable(spark, path, HOURLY_PRICES, HOUR_KEY)


def hour_state_table(spark: SparkSession, path: str, kind: list[str]) -> DayTable:
    """Mergeable states of the hours of series named by ``kind``."""
    names = ", ".join(f"{name} string" for name in kind)
    return DayTable(spark, path, f"{names}, {HOUR_STATE}", [*kind, "hour_start_utc"])


def listed_days(rows: DataFrame, day: str = DAY) -> list[dt.date]:
    """The days in ``rows``, of which a calendar holds few."""
    return sorted(row[0] for row in rows.select(day).distinct().collect())


def day_folders(spark: SparkSession, path: str, day: str, days: Iterable[dt.date]) -> list[str]:
    """The partition folders of ``days`` below ``path`` that exist; no other is looked at."""
    folders = [f"{path}/{day}={date.isoformat()}" for date in days]
    return [folder for folder in folders if _exists(spark, folder)]


def calendar_days(first: dt.date, last: dt.date) -> list[dt.date]:
    return [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]


def remove_folder(spark: SparkSession, path: str) -> None:
    files, folder = _files(spark, path)
    files.delete(folder, True)


def _files(spark: SparkSession, path: str) -> tuple:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _rename(spark: SparkSession, source: str, target: str) -> bool:
    """Move a folder to a path that nothing has, in one step; whether it was free."""
    fs = spark._jvm.org.apache.hadoop.fs
    files, start = _files(spark, source)
    start, end = files.makeQualified(start), files.makeQualified(fs.Path(target))
    kind = getattr(fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    context = fs.FileContext.getFileContext(start.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(start, end, options)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def _exists(spark: SparkSession, path: str) -> bool:
    files, folder = _files(spark, path)
    return files.exists(folder)
