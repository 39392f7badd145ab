"""Extension: SC1 applied to a stream of raw rows with Structured Streaming.

The reference has no streaming; the fitted feature / representation / model
stages are stateless at transform time, so scoring a micro-batch is the same
plan as batch scoring. ``foreachBatch`` writes each batch's predictions with
the batch id, so a restarted query (checkpointed offsets) rewrites the same
batch idempotently.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.io import PREDICTION_COL


def score_stream(spark: SparkSession, source_dir: str, schema: T.StructType, model, out_dir: str, checkpoint_dir: str,
                 key: str = "ID", target: str = "price", available_now: bool = True):
    """Start a streaming query scoring Parquet files arriving in ``source_dir`` into ``out_dir``."""
    stream = spark.readStream.schema(schema).parquet(source_dir)

    def sink(batch: DataFrame, batch_id: int) -> None:
        feats = batch.drop(target) if target in batch.columns else batch
        out = model.transform(feats).select(key, F.col("prediction").alias(PREDICTION_COL), F.lit(batch_id).alias("batch_id"))
        out.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
