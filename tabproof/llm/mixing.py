"""Mixing sources to target weights by systematic sampling, in DataFrame expressions only.

Inside a source, documents are put in the order of their size, and ties in that of a hash
of their id. Each expects ``target / source size`` copies. The prefix sum of these
expectations plus one random offset per source crosses an integer boundary as often as the
document is taken. Neighbours in the order are of like size, so the words taken stay near
the target, off by about one document's size.

The rank of a document is the number of those in smaller sizes of its source, plus those
of its size under smaller hash prefixes, plus its place in the last bucket. The first two
come from counts that are combined before the shuffle; only the last needs rows of a
bucket together, and a bucket is one 256th of one size of one source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabproof.llm.spool import spool

#: Weights dealt to the sources in turn, most copies of one document.
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters that are not blanks; null has none."""
    # Each run becomes one letter and each blank goes, which leaves as many letters as runs.
    return F.length(F.regexp_replace(
        F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "x"), r"[^x]+", "")).cast("bigint")


def fraction(text: Column) -> Column:
    """A number in [0, 1) drawn from the hash of ``text``."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS,
                   most: int = MOST_COPIES) -> DataFrame:
    """Words to take per source: ``source, source_size, target``.

    ``sizes`` has one row per source with its ``source_size``. All words are shared by
    weight; a target ends at ``most`` times its source, and what is cut goes to the others
    by weight. That ends where each target is the smaller of its limit and ``level *
    weight``. Sources sorted by limit per weight are full up to a place, so the level
    follows from two running sums. The windows see one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    by_limit = Window.orderBy("ratio", "place")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    dealt = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (
        sizes.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", dealt[(F.col("place") - 1) % len(weights)])
        .withColumn("limit", F.col("source_size").cast("double") * most)
        .withColumn("ratio", F.col("limit") / F.col("weight"))
    )
    # The level if all sources before this one are full and this one and the rest are not.
    levels = (
        ranked.withColumn("total", F.sum(F.col("source_size").cast("double")).over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("full", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("gone", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("full")) / (F.col("all_weight") - F.col("gone")))
    )
    # Of the levels that the own limit does not undercut, the first in order is the one.
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place", "level")))
    return levels.withColumn("chosen", level.over(everything)["level"]).select(
        "source", "source_size",
        F.least(F.col("limit"), F.coalesce(F.col("chosen") * F.col("weight"), F.col("limit"))).alias("target"),
    )


def _identity() -> Column:
    """Digest of a document's id, source and text; null and empty ones differ."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in ("doc_id", "source", "text")]
    return F.unhex(F.md5(F.concat_ws("\x00", *parts)))


def mix_sources(docs: DataFrame, weights: Sequence[float] = WEIGHTS,
                most: int = MOST_COPIES, seed: str = "mix") -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, copies``.

    ``size`` is the number of words, ``taken`` the words the mix takes of the document with
    repeats, ``copies`` how often it is taken (never above ``most``). Sources are ranked by
    code point with null last and get ``weights`` in turn. Null and empty texts have size 0;
    such documents are drawn like others and add no words. Documents without an id are drawn
    by their text; those equal in source, size and draw are interchangeable. A run with the
    same rows and ``seed`` gives the same result. An empty table gives no rows; other columns
    are not looked at.
    """
    return _mixed(docs, weights, most, seed, F.lit(None).cast("binary")).drop("mark")


def _mixed(docs: DataFrame, weights: Sequence[float], most: int, seed: str, mark: Column) -> DataFrame:
    """:func:`mix_sources` with a ``mark`` of each document, which also settles ties."""
    drawn_by = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce("text", F.lit("")))))
    thin = spool(
        docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"),
            F.md5(F.concat(F.lit(f"{seed}:"), drawn_by)).alias("draw"), mark.alias("mark"),
        ),
        "mix-sizes",
    ).withColumn("part", F.substring("draw", 1, 2))
    cells = thin.groupBy("source", "size", "part").agg(F.count(F.lit(1)).alias("n"))
    cells = spool(cells, "mix-counts")
    sizes = cells.groupBy("source", "size").agg(F.sum("n").alias("n"))
    targets = source_targets(
        sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")),
        weights, most)
    smaller = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "source", "size", F.coalesce(F.sum("n").over(smaller), F.lit(0)).alias("before_size"))
    inside = (Window.partitionBy("source", "size").orderBy("part")
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = cells.withColumn("before_part", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    starts = _beside(starts, sizes, ["source", "size"])
    starts = spool(_beside(starts, targets, ["source"]).select(
        "source", "size", "part", "source_size", "target",
        (F.col("before_size") + F.col("before_part")).alias("start")), "mix-starts")
    bucket = Window.partitionBy("source", "size", "part").orderBy("draw", "doc_id", "mark")
    ranked = _beside(thin.withColumn("place", F.row_number().over(bucket)), starts,
                     ["source", "size", "part"])
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = fraction(F.concat(F.lit(f"{seed}:source:"), F.coalesce("source", F.lit(""))))
    rank = F.col("start") + F.col("place")
    crossed = F.floor(rank * share + offset) - F.floor((rank - 1) * share + offset)
    return ranked.withColumn("copies", crossed.cast("bigint")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "copies", "mark")


def _beside(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which null keys are equal; the keys stay once."""
    renamed = right.select(*[F.col(c).alias(f"_{c}" if c in keys else c) for c in right.columns])
    on = F.lit(True)
    for key in keys:
        on = on & left[key].eqNullSafe(renamed[f"_{key}"])
    return left.join(renamed, on).drop(*[f"_{k}" for k in keys])


def take_mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS,
             most: int = MOST_COPIES, seed: str = "mix") -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its document is taken.

    Documents are matched by id, source and text together. Rows that repeat all three are
    one document here, taken as often as the mix takes them in all.
    """
    copies = _mixed(docs, weights, most, seed, _identity()).groupBy(F.col("mark").alias("_of_mark")).agg(
        F.sum("copies").cast("int").alias("_mix_copies")).where("_mix_copies > 0")
    marked = docs.withColumn("_mix_mark", _identity()).dropDuplicates(["_mix_mark"])
    joined = marked.join(copies, F.col("_mix_mark") == F.col("_of_mark"))
    repeated = joined.select(*[F.col(f"`{c}`") for c in docs.columns],
                             F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))).alias("_mix_copy"))
    return repeated.drop("_mix_copy")
