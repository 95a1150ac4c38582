"""Load documents as they land."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gridmart.plans.ingest import Feed, ingest
from gridmart.schemas import DEFAULT_ZONE
from gridmart.session import prepare
from gridmart.sources.documents import stream_documents


def ingest_stream(
    spark: SparkSession,
    archive: str,
    path: str,
    feed: Feed,
    zone: str = DEFAULT_ZONE,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Load the days to which something was added since the last call, then stop.

    What has landed is one batch, an ingest of its own, of all documents of these days: of
    late, replayed or reordered fetches the newest wins, as in a run over the whole
    archive. A batch that is repeated after a failure upserts the same rows again, so the
    table ends the same. Failing documents stay out, with their verdicts under the batch
    number. Progress, one number for each day of the archive, is kept beside the table
    unless ``checkpoint`` names another place that all executors share.
    """
    prepare(spark)

    def load(docs: DataFrame, batch: int) -> None:
        ingest(docs, path, feed, zone, strict=False, run=str(batch))

    return (
        stream_documents(spark, archive)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint or f"{path}_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
