"""Exact duplicates: group by a 128-bit content hash, compare bytes inside the groups.

Only DataFrame expressions. Copies meet on their own task before the shuffle (one row per
text and task travels), so a text that fills a third of the table is no hot key. The
verdicts go back to the documents in a join of thin rows, which adaptive execution splits
where a key is hot.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that do not count when texts are compared.
BLANKS = r"[\x20\x09-\x0D]+"
#: Width of the part of a rank that holds the id, and the number an id is taken from.
_IDS = str(2**65)
_TOP = str(2**63)


def normalised(text: Column) -> Column:
    """``text`` without blanks; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


def md5_digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _rank() -> Column:
    """One fixed-width number per row, so that the maximum needs no sort: longest text
    first, then smallest id."""
    wide = "decimal(38,0)"
    by_id = F.coalesce(F.lit(_TOP).cast(wide) - F.col("doc_id").cast(wide), F.lit(0).cast(wide))
    n_chars = F.length(F.coalesce(F.col("text"), F.lit("")))
    return (n_chars.cast(wide) * F.lit(_IDS).cast(wide) + by_id).cast(wide)


def _groups(rows: DataFrame) -> DataFrame:
    """``digest, sha, group_size, best`` of each group of equal texts."""
    return rows.groupBy("digest", "norm").agg(
        F.max("rank").alias("best"), F.count(F.lit(1)).alias("group_size")).select(
        "digest", F.unhex(F.sha2("norm", 256)).alias("sha"), "group_size", "best")


def exact_duplicates(
    docs: DataFrame, digest: Callable[[Column], Column] = md5_digest
) -> DataFrame:
    """One row per document: which document of its group of equal texts stays.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``. Of equal texts the one with
    the most code points in the original stays, then the smallest ``doc_id``; a null id
    comes last. A null text is an empty one, and empty texts are equal. Rows that repeat
    both id and text cannot be told apart: they count in ``group_size`` and share the
    verdict. An empty table gives no rows; other columns are not looked at.

    ``digest`` makes the 128-bit group key. Texts with the same key are compared byte by
    byte, so a weak digest costs time and changes nothing.
    """
    rows = docs.select(
        F.col("doc_id"), normalised(F.col("text")).alias("norm"), _rank().alias("rank"),
    ).withColumn("digest", digest(F.col("norm")))
    groups = _groups(rows)
    wide = "decimal(38,0)"
    id_part = F.col("best") % F.lit(_IDS).cast(wide)
    groups = groups.select(
        F.col("digest").alias("of_digest"), F.col("sha").alias("of_sha"), "group_size", "best",
        F.when(id_part != 0, (F.lit(_TOP).cast(wide) - id_part).cast("bigint")).alias("keep_id"),
    )
    members = rows.select(
        "doc_id", "digest", F.unhex(F.sha2("norm", 256)).alias("sha"), "rank")
    joined = members.join(
        groups,
        (F.col("digest") == F.col("of_digest")) & (F.col("sha") == F.col("of_sha")),
    )
    return joined.select(
        "doc_id", "keep_id", "group_size",
        (F.col("rank") == F.col("best")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns; rows repeating id and text become one.

    A row stays by its text, its length and its id together, so different texts under one
    id, or without id, do not speak for each other. The verdict join leaves the rows dealt
    out by these, so the last step needs no exchange of its own.
    """
    norm = normalised(F.col("text"))
    best = _groups(docs.select(
        norm.alias("norm"), _rank().alias("rank"), md5_digest(norm).alias("digest")))
    best = best.select(F.col("sha").alias("_of_sha"), F.col("best").alias("_best"))
    rows = docs.withColumns({"_sha": F.unhex(F.sha2(norm, 256)), "_rank": _rank()})
    staying = rows.join(
        best, (F.col("_sha") == F.col("_of_sha")) & (F.col("_rank") == F.col("_best")), "left_semi")
    return staying.dropDuplicates(["_sha", "_rank"]).drop("_sha", "_rank")
