"""Scoring a stream of observations with a fitted model.

Feature hashing is a narrow projection, so it applies to a streaming frame
as is. Scoring reuses the batch plan on each micro-batch through
``foreachBatch``; output goes to one folder per epoch, overwritten on replay,
so a restarted query rewrites rather than duplicates a batch. The query's
checkpoint lives under the cluster's shared ``spark.checkpoint.dir`` unless
a location is given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.hashing import DEFAULT_BUCKETS, hash_features
from ..operators.model import LogisticModel, predict
from ..session import ensure_checkpoint_dir
from ..sources.tables import ctr_event_features, table_observations


def ctr_event_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """Click observations over a stream of ``events`` files (same view as the batch one)."""
    ev = spark.readStream.schema(schema).parquet(path)
    return table_observations(ev, F.col("event_id"),
                              F.when(F.col("event_type") == "click", 1).otherwise(0),
                              ctr_event_features())


def hashed_stream(obs: DataFrame, num_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Hashed features of a streaming observation frame (no state, no shuffle)."""
    return hash_features(obs, num_buckets)


def parquet_epoch_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Write each micro-batch to ``path/epoch=<id>``, replacing it on replay."""
    def sink(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/epoch={epoch_id}")
    return sink


def score_stream(features: DataFrame, model: LogisticModel,
                 sink: Callable[[DataFrame, int], None], checkpoint_location: str | None = None,
                 query_name: str = "respengine_scores", available_now: bool = False
                 ) -> StreamingQuery:
    """Start a query that scores every micro-batch of encoded rows with ``model``."""
    spark = features.sparkSession
    if checkpoint_location is None:
        checkpoint_location = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{query_name}"

    def run(batch: DataFrame, epoch_id: int) -> None:
        sink(predict(model, batch), epoch_id)

    writer = (features.writeStream.queryName(query_name).foreachBatch(run)
              .option("checkpointLocation", checkpoint_location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
