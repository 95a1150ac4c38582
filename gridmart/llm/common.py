"""What the operators share: reading documents, stored intermediate tables, arrow columns."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from gridmart.session import new_folder


# Stands for a null id in keys; it is greater than any id.
NO_ID = (1 << 63) - 1

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a table to the folder all executors share, and read it from there.

    It cuts the lineage: a lost executor costs the tasks it held, not the steps before.
    The shuffle files of the job go when it has ended, not when the driver next happens
    to collect its garbage.
    """
    spark = frame.sparkSession
    folder = new_folder(spark, f"llm-{name}")
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        frame.write.parquet(folder)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(frame.schema).parquet(folder)


def forget(frame: DataFrame) -> None:
    """Delete a stored table that nothing reads any more, so its disk is free at once."""
    spark = frame.sparkSession
    files = frame.inputFiles()
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def whole(text: Column | str) -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def row_key(tag: Column) -> list[Column]:
    """Two columns, never null, that tell documents apart: join keys ``_id`` and ``_tag``.

    ``tag`` is a hash of the text, for tables in which an id repeats or is null.
    """
    missing = F.col("doc_id").isNull()
    return [
        F.coalesce(F.col("doc_id"), F.lit(NO_ID)).cast("long").alias("_id"),
        F.when(missing, F.bitwise_not(tag)).otherwise(tag).alias("_tag"),
    ]


def once(docs: DataFrame, tag: Column) -> tuple[DataFrame, DataFrame]:
    """``_id``, ``_tag`` and whole ``text`` of each document, copies of a row only once;
    and, stored, those that have copies.

    Only keys are counted, and only the copies are grouped, with a partial result on each
    map task: a key with very many copies leaves it as one row.
    """
    keys = ["_id", "_tag"]
    keyed = docs.select(*row_key(tag), whole("text").alias("text"))
    counted = docs.select(*row_key(tag)).groupBy(keys).agg(F.count("*").alias("c"))
    several = stored(counted.filter("c > 1").select(keys), "copied")
    copied = keyed.join(several, keys, "left_semi").dropDuplicates(keys)
    copied = stored(copied, "copies")
    return keyed.join(several, keys, "left_anti").union(copied), copied


def quoted(names: Iterable[str]) -> list[str]:
    """Column names as they are, whatever characters they hold."""
    return ["`" + name.replace("`", "``") + "`" for name in names]


def on_keys(left: str, right: str, keys: Iterable[str]) -> Column:
    """Equality of the keys of two aliased tables, null meeting null."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition


def map_batches(
    frame: DataFrame,
    function: Callable[[pa.RecordBatch], Iterable[dict]],
    schema: str,
    prepare: Callable[[], object] | None = None,
    trim_every: int = 1,
) -> DataFrame:
    """Apply ``function`` to every Arrow batch; it yields columns as a dict of arrays.

    ``prepare`` runs once a task; its value is handed on as the second argument. For
    ``trim_every`` see ``map_arrow``.
    """
    types = pa_schema(frame.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = prepare() if prepare else None
        for batch in batches:
            for columns in function(batch, state) if prepare else function(batch):
                yield pa.RecordBatch.from_arrays(
                    [
                        column
                        if isinstance(column, pa.Array)
                        else pa.array(column, type=types.field(name).type)
                        for name, column in ((n, columns[n]) for n in types.names)
                    ],
                    schema=types,
                )

    return map_arrow(frame, run, schema, trim_every)


def map_arrow(
    frame: DataFrame,
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
    trim_every: int = 1,
) -> DataFrame:
    """``mapInArrow`` whose workers give freed memory back after every batch, or after every
    ``trim_every`` of them, and at the end.

    Workers serve one stage after another. What the allocators keep of a large batch
    would otherwise add up over the stages of a job. Memory that the next batch takes again
    costs time for every page.
    """

    def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        try:
            for number, batch in enumerate(run(batches), 1):
                yield batch
                del batch
                if number % trim_every:
                    continue
                pa.default_memory_pool().release_unused()
                if trim:
                    trim(0)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if trim:
                trim(0)

    if isinstance(schema, str) or not any(set(".`") & set(name) for name in frame.columns):
        return frame.mapInArrow(trimmed, schema)

    # Spark reads a dot in the name of a column as a field of it: plain names in between.
    names, results = frame.columns, schema.names
    plain = frame.toDF(*[f"c{i}" for i in range(len(names))])
    fields = [StructField(f"c{i}", field.dataType) for i, field in enumerate(schema)]

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batch.rename_columns(names) for batch in batches):
            yield batch.rename_columns([f"c{i}" for i in range(len(results))])

    return plain.mapInArrow(renamed, StructType(fields)).toDF(*results)


def pa_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def chunks(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` characters; one longer text makes a range of its own."""
    first, size = 0, 0
    for row, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield first, row
            first, size = row, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)
