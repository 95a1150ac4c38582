"""The document archive: ``<root>/delivery_date=<day>/<any name>``, one document a file.

A later fetch of the same day must land under a new name, moved into its folder whole:
with distinct names the landing order tells which fetch is the newest.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.sources.landed import LandedDocuments
from gridmart.sources.tables import calendar_days, day_folders

_FILE = "value string, delivery_date date"
_DOCUMENT = "document string, delivery_date date, landed_at timestamp, path string"

# What identifies a fetch, oldest first when sorted.
FETCH_ORDER = ["landed_at", "path"]


def _documents(files: DataFrame) -> DataFrame:
    return files.select(
        F.col("value").alias("document"),
        "delivery_date",
        F.col("_metadata.file_modification_time").alias("landed_at"),
        F.col("_metadata.file_path").alias("path"),
    )


def read_documents(
    spark: SparkSession,
    root: str,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """Documents of the days in [first, last]; with both, other day folders are not even listed."""
    reader = spark.read.format("text").schema(_FILE).option("wholetext", True)
    if first is not None and last is not None:
        folders = day_folders(spark, root, "delivery_date", calendar_days(first, last))
        if not folders:
            return spark.createDataFrame([], _DOCUMENT)
        files = reader.option("basePath", root).load(folders)
    else:
        files = reader.load(root)
    if first is not None:
        files = files.filter(F.col("delivery_date") >= F.lit(first))
    if last is not None:
        files = files.filter(F.col("delivery_date") <= F.lit(last))
    return _documents(files)


def stream_documents(spark: SparkSession, root: str) -> DataFrame:
    """The documents of each day under ``root`` to which something was added, as a stream.

    What is remembered is one number a day; see ``landed.py``. A file of any age is read.
    """
    spark.dataSource.register(LandedDocuments)
    return spark.readStream.format(LandedDocuments.name()).option("root", root).load()


def land_documents(docs: DataFrame, root: str) -> None:
    """Add ``document`` texts to the archive, each as a file with a fresh name."""
    (
        docs.select("document", "delivery_date")
        .write.mode("append")
        .partitionBy("delivery_date")
        .option("maxRecordsPerFile", 1)
        .text(root)
    )
