"""The daily run driven by a stream of landed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from txnrisk.plans.pipeline import run_pipeline
from txnrisk.session import scratch
from txnrisk.sources.tables import LayerStore


def run_pipeline_stream(store: LayerStore, raw: DataFrame, as_of: str, checkpoint: str, **options) -> None:
    """Bring the layers up to date with each micro-batch until none is left.

    Velocity, travel and new-device features are exact here: every micro-batch
    goes through the incremental operators and their state tables. A repeated
    micro-batch is harmless, as the run upserts by transaction id.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        # Staged so that the run itself plans on the store's own session.
        staged = scratch(store.spark, f"micro-batch-{batch_id}")
        batch.write.parquet(staged)
        run_pipeline(store, store.spark.read.schema(raw.schema).parquet(staged), as_of, **options)

    query = (raw.writeStream.foreachBatch(handle).trigger(availableNow=True)
             .option("checkpointLocation", checkpoint).start())
    query.awaitTermination()
