"""Incremental runs: new files since the last run, through the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.operators.store import Store
from citeloom.plans.pipeline import front_of, ingest


def stream_texts(spark: SparkSession, folder: str, checkpoint: str, handle: Callable[[DataFrame, int], None], schema: str = "filename string, text string") -> None:
    """Pass every parquet file of documents in ``folder`` that no earlier run saw to ``handle``, in
    micro-batches, and stop. Resolution spans all keys, so it is a batch step on each new slice
    and the stores, not a keyed state; the checkpoint makes each file count once."""
    stream = spark.readStream.schema(schema).parquet(folder)
    q = (
        stream.withColumn("sha256", F.sha2("text", 256))
        .writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    q.awaitTermination()


def stream_into(spark: SparkSession, folder: str, checkpoint: str, stores: Store) -> None:
    """Run the pipeline over every new parquet file of documents (filename, text) in ``folder``. What
    stands before the bibliography is taken as first page. A micro-batch that is delivered again changes nothing, since
    documents are known by their content."""

    def handle(docs: DataFrame, _: int) -> None:
        none = F.lit(None).cast("string")
        ingest(spark, stores, docs.select("sha256", "filename", "text", front_of(F.col("text")).alias("page1"), none.alias("meta_title"), none.alias("meta_author"), none.alias("error")))

    stream_texts(spark, folder, checkpoint, handle)
