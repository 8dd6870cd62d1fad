"""Applying fitted pipelines to a stream: the same narrow projection as on a batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tabproof.functions.columns import quoted
from tabproof.operators.metrics import DECISION_THRESHOLD, hard_predictions


def prepare_stream(model: PipelineModel, stream: DataFrame) -> DataFrame:
    """Prepared features of each arriving record. Nothing is fitted again."""
    return model.transform(stream)


def score_stream(
    model: PipelineModel, stream: DataFrame, threshold: float = DECISION_THRESHOLD
) -> DataFrame:
    """Probability and 0/1 prediction of each arriving record."""
    scored = model.transform(stream).drop("features", "rawPrediction", "prediction")
    return hard_predictions(scored, "probability", threshold)


def write_stream(
    scored: DataFrame, path: str, checkpoint: str, available_now: bool = True,
    sink_format: str = "parquet",
) -> StreamingQuery:
    """Append results to files; the checkpoint makes the output exactly-once."""
    writer = (
        scored.writeStream.format(sink_format).outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", path)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _write_batch(path: str) -> Callable[[DataFrame, int], None]:
    """A sink whose batches replace themselves: one folder per batch, so a batch that is
    replayed after a failure leaves its rows once."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def write_scores(scored: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write each batch of scores to its own folder, in any sink format Spark overwrites.

    The checkpoint numbers the batches; a restart repeats the last unfinished number with
    the same rows. Read the result with :func:`read_scores`.
    """
    writer = scored.writeStream.foreachBatch(_write_batch(path)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """All scores written so far; ``batch`` is the number of each row's batch."""
    return spark.read.option("basePath", path).parquet(path)


def running_confusion(predicted: DataFrame, label: str, prediction: str = "predicted") -> DataFrame:
    """Confusion cells over all records of a stream so far, as a streaming aggregate.

    The state is one row, whatever has arrived. Records without a label are left out.
    """
    truth, said = quoted(label).cast("int"), quoted(prediction).cast("int")
    return predicted.where(truth.isNotNull()).groupBy().agg(
        F.count_if((truth == 1) & (said == 1)).alias("true_positives"),
        F.count_if((truth == 0) & (said == 1)).alias("false_positives"),
        F.count_if((truth == 0) & (said == 0)).alias("true_negatives"),
        F.count_if((truth == 1) & (said == 0)).alias("false_negatives"))
