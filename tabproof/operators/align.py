"""Bringing labels and scores that arrive apart together, one to one."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabproof.errors import EvaluationError
from tabproof.functions.columns import quoted
from tabproof.sources.shared import stored


def _paired(truth: DataFrame, scores: DataFrame, row_id, label, score) -> DataFrame:
    """One row per id with how often each side has it.

    Grouping the stacked sides instead of joining them means that an id repeated on
    both sides is counted, never multiplied out.
    """
    ids = [quoted(name) for name in row_id]
    no_label = F.lit(None).cast(truth.schema[label].dataType)
    no_score = F.lit(None).cast(scores.schema[score].dataType)
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    stacked = truth.select(
        *ids, quoted(label).alias("label"), no_score.alias("score"),
        one.alias("in_truth"), zero.alias("in_scores"),
    ).unionByName(scores.select(
        *ids, no_label.alias("label"), quoted(score).alias("score"),
        zero.alias("in_truth"), one.alias("in_scores"),
    ))
    return stacked.groupBy(*ids).agg(
        F.first("label", ignorenulls=True).alias("label"),
        F.first("score", ignorenulls=True).alias("score"),
        F.sum("in_truth").alias("in_truth"), F.sum("in_scores").alias("in_scores"),
    )


def alignment_summary(truth, scores, row_id, label: str, score: str) -> DataFrame:
    """One row: ids matched one to one, ids on one side only, ids that repeat."""
    row_id = [row_id] if isinstance(row_id, str) else list(row_id)
    a, b = F.col("in_truth"), F.col("in_scores")
    return _paired(truth, scores, row_id, label, score).agg(
        F.count_if((a == 1) & (b == 1)).alias("matched"),
        F.count_if((a > 0) & (b == 0)).alias("truth_only"),
        F.count_if((a == 0) & (b > 0)).alias("scores_only"),
        F.count_if((a > 1) | (b > 1)).alias("repeated"),
    )


def align_scores(truth, scores, row_id, label: str, score: str) -> DataFrame:
    """(row id, label, score) for every id, or an error when the sides do not pair up."""
    row_id = [row_id] if isinstance(row_id, str) else list(row_id)
    facts = alignment_summary(truth, scores, row_id, label, score).first()
    if facts["truth_only"] or facts["scores_only"] or facts["repeated"]:
        raise EvaluationError(
            f"labels and scores do not pair up: {facts['truth_only']} id(s) without a score, "
            f"{facts['scores_only']} without a label, {facts['repeated']} repeated")
    paired = _paired(truth, scores, row_id, label, score)
    return paired.select(*[quoted(name) for name in row_id], "label", "score")


def row_positions(df: DataFrame, columns: list[str]) -> DataFrame:
    """``position`` of each row, from 0, and the given columns.

    A table read from files counts in the order of its files' addresses and of the rows in
    them; any other one in the order of its partitions. Rows are numbered within the ranges
    that tasks read, and a running sum over the ranges' counts gives where each starts. The
    numbered rows are stored, so both steps see the same ranges.
    """
    row = F.monotonically_increasing_id().alias("row")
    kept = [quoted(name).alias(f"c{i}") for i, name in enumerate(columns)]
    try:
        places = df.select(F.col("_metadata.file_path").alias("file"),
                           F.col("_metadata.file_block_start").alias("block"), row, *kept)
    except AnalysisException:
        places = df.select(F.lit("").alias("file"), F.spark_partition_id().cast("bigint").alias("block"), row, *kept)
    places = stored(places, "row-positions")
    ranges = places.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    # A row per range from here to the join.
    before = Window.partitionBy(F.lit(0)).orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return places.join(starts, ["file", "block"]).select(
        (F.col("row") + F.col("shift")).alias("position"),
        *[F.col(f"c{i}").alias(name) for i, name in enumerate(columns)])


def align_by_position(truth: DataFrame, scores: DataFrame, label: str, score: str) -> DataFrame:
    """(position, label, score): the n-th label beside the n-th score, without any id.

    Raises if the sides differ in length.
    """
    labels = row_positions(truth, [label]).select("position", quoted(label).alias("label"))
    values = row_positions(scores, [score]).select("position", quoted(score).alias("score"))
    n_labels, n_scores = labels.count(), values.count()
    if n_labels != n_scores:
        raise EvaluationError(f"there are {n_labels} label(s) but {n_scores} score(s)")
    return labels.join(values, "position")
