"""Streaming (ST0). The reference is batch-only; this is the optional,
minimal streaming face of the same operators: incoming trip events are
de-duplicated inside a watermark (P5's keep-one semantics for a stream) and
scored with a fitted ``PipelineModel`` (L14), per micro-batch."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_stream(events: DataFrame, keys: list[str], event_time: str,
                 delay: str = "10 minutes") -> DataFrame:
    """Drop repeated keys within the watermark delay (bounded state)."""
    return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def score_stream(events: DataFrame, model: PipelineModel, prob_out: str = "proba") -> DataFrame:
    """Score each micro-batch with a fitted pipeline (stateless)."""
    from pyspark.ml.functions import vector_to_array
    scored = model.transform(events)
    if "probability" in scored.columns:
        arr = vector_to_array(F.col("probability"))
        scored = scored.withColumn(prob_out, F.element_at(arr, F.size(arr)))
    return scored


def windowed_counts(events: DataFrame, event_time: str, key: str, width: str = "1 hour",
                    delay: str = "10 minutes") -> DataFrame:
    """Tumbling-window counts per key with a watermark (late rows beyond the
    delay are dropped by the engine, state is bounded)."""
    return (events.withWatermark(event_time, delay)
                  .groupBy(F.window(event_time, width), key).agg(F.count(F.lit(1)).alias("n")))
