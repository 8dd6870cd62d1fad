"""Quality classifier from weak labels.

Nine heuristics look at every text and vote good, bad or not at all. Expectation
maximisation over the counts of vote patterns of the whole table estimates how often each
heuristic errs on good and on bad texts, without any given label. The posterior labels of
a bounded sample train a logistic regression on hashed features of the text's shape, and
that linear scorer judges every document.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabproof.llm.spool import spool

#: Documents that the scorer is fitted on: as many on average, twice as many at most.
FIT_ROWS = 10_000
#: Hashed features.
BUCKETS = 1024
#: Documents scoring below are rejected.
THRESHOLD = 0.5
ROUNDS = 200
#: What is known of the heuristics beforehand: each looks for one kind of bad text, so it
#: overlooks at least half of the bad ones, and it accuses few good ones.
LEAST_MISSED = 0.5
MOST_FALSE = 0.01

GOOD, BAD, NONE = 1, 0, 2
HEURISTICS = ("symbols", "capitals", "exclamations", "cells", "repeats", "variety", "function words",
              "sentences", "repeated lines")
_SYMBOLS = np.frombuffer(b"#$%&*+<=>@[\\]^_`{|}~", np.uint8)
#: Frequent function words of the languages at hand.
_FUNCTION_WORDS = frozenset(
    "the of and to in a is it for on with as are be this was that by or from at an "
    "de la le et les des en un une du que est pour dans qui sur par au pas avec "
    "der die und das in den von zu mit ist im des auf ein eine für nicht dem als sich "
    "el los las y del se por con una su para al lo no como es".split())


@dataclass(frozen=True)
class Looks:
    """What the heuristics and the scorer see of one text."""

    raw: np.ndarray
    counts: np.ndarray
    n_words: int
    symbols: float
    capitals: float
    exclamations: float
    cells: float
    repeats: float
    variety: float
    function_words: float
    sentences: float
    repeated_lines: float
    n_lines: int


def look(text: str) -> Looks:
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    counts = np.bincount(raw, minlength=256)
    words = text.split()
    n = max(len(words), 1)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    visible = max(len(raw) - int(counts[[9, 10, 11, 12, 13, 32]].sum()), 1)
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    return Looks(
        raw=raw, counts=counts, n_words=len(words),
        symbols=float(counts[_SYMBOLS].sum()) / visible,
        capitals=upper / max(upper + lower, 1),
        exclamations=float(counts[33]) / n,
        cells=float(counts[124]) / n,
        repeats=sum(map(eq, words, words[1:])) / n,
        variety=len(set(words)) / n,
        function_words=sum(map(_FUNCTION_WORDS.__contains__, words)) / n,
        sentences=sum(x.rstrip()[-1] in ".!?:;\"')" for x in lines) / max(len(lines), 1),
        repeated_lines=1 - len(set(lines)) / max(len(lines), 1),
        n_lines=len(lines),
    )


def votes(seen: Looks) -> list[int]:
    """One vote per heuristic; a text without words gets none."""

    def above(value: float, bad: float, good: float, enough: bool = True) -> int:
        return BAD if value > bad and enough else GOOD if value < good else NONE

    def below(value: float, bad: float, good: float, enough: bool = True) -> int:
        return GOOD if value > good else BAD if value < bad and enough else NONE

    if not seen.n_words:
        return [NONE] * len(HEURISTICS)
    return [
        above(seen.symbols, 0.08, 0.03),
        above(seen.capitals, 0.6, 0.2),
        above(seen.exclamations, 0.3, 0.05),
        above(seen.cells, 0.2, 0.01),
        above(seen.repeats, 0.3, 0.05, seen.n_words >= 10),
        below(seen.variety, 0.15, 0.3, seen.n_words >= 30),
        below(seen.function_words, 0.02, 0.08, seen.n_words >= 20),
        below(seen.sentences, 0.2, 0.7, seen.n_lines >= 3),
        above(seen.repeated_lines, 0.5, 0.1, seen.n_lines >= 3),
    ]


def _shape_table() -> bytes:
    table = bytearray(range(256))
    for first, last, letter in ((65, 90, 65), (97, 122, 97), (48, 57, 48), (128, 255, 97), (9, 9, 32),
                                (11, 13, 32)):
        table[first:last + 1] = bytes([letter]) * (last + 1 - first)
    return bytes(table)


_SHAPE = np.frombuffer(_shape_table(), np.uint8)


def features(seen: Looks) -> np.ndarray:
    """Hashed vector: shares of three-letter shapes, and the bins of the measures."""
    vector = np.zeros(BUCKETS)
    shape = _SHAPE[seen.raw].astype(np.uint32)
    if len(shape) >= 3:
        grams = (shape[:-2] << 16 | shape[1:-1] << 8 | shape[2:]) * np.uint32(2654435761)
        vector += np.sqrt(np.bincount(grams >> 22, minlength=BUCKETS) / len(grams))
    for name in ("symbols", "capitals", "exclamations", "cells", "repeats", "variety",
                 "function_words", "sentences", "repeated_lines"):
        bin_ = min(int(getattr(seen, name) * 10), 10)
        vector[zlib.crc32(f"{name}:{bin_}".encode()) % BUCKETS] += 1.0
    return vector


@dataclass(frozen=True)
class LabelModel:
    """``vote_share[h, c, v]``: how often heuristic h votes v on texts of class c."""

    prior: float
    vote_share: np.ndarray

    def posterior(self, pattern: str) -> float:
        """Probability that a text with these votes is good."""
        odds = math.log(self.prior) - math.log1p(-self.prior)
        for h, vote in enumerate(map(int, pattern)):
            if vote != NONE:
                odds += math.log(self.vote_share[h, GOOD, vote] / self.vote_share[h, BAD, vote])
        return 1 / (1 + math.exp(-max(min(odds, 500), -500)))


def fit_label_model(patterns: Mapping[str, int]) -> LabelModel:
    """Expectation maximisation over counts of vote patterns.

    An absent vote says nothing. Votes are taken as independent given the class. The rates
    keep to what is known of the heuristics, which also settles which class is good.
    """
    size = len(HEURISTICS)
    share = np.empty((size, 2, 2))
    share[:, GOOD] = MOST_FALSE, 1 - MOST_FALSE
    share[:, BAD] = 0.3, 0.7
    model = LabelModel(0.8, share)
    keys = [*patterns]
    weight = np.array([patterns[k] for k in keys], float)
    cast = np.array([[int(v) for v in k] for k in keys]).reshape(len(keys), size)
    for _ in range(ROUNDS if keys else 0):
        good = np.array([model.posterior(k) for k in keys])
        new = np.empty_like(share)
        for c, of_class in ((GOOD, good * weight), (BAD, (1 - good) * weight)):
            for v in (BAD, GOOD):
                new[:, c, v] = (of_class[:, None] * (cast == v)).sum(0) + (1.0 if v == c else 0.5)
        new /= new.sum(2, keepdims=True)
        new[:, GOOD, BAD] = np.minimum(new[:, GOOD, BAD], MOST_FALSE)
        new[:, BAD, GOOD] = np.maximum(new[:, BAD, GOOD], LEAST_MISSED)
        new[:, GOOD, GOOD] = 1 - new[:, GOOD, BAD]
        new[:, BAD, BAD] = 1 - new[:, BAD, GOOD]
        prior = float(np.clip((good @ weight + 1) / (weight.sum() + 2), 1e-3, 1 - 1e-3))
        done = np.abs(new - model.vote_share).max() < 1e-6
        model = LabelModel(prior, new)
        if done:
            break
    return model


@dataclass(frozen=True)
class Scorer:
    weights: np.ndarray
    intercept: float

    def score(self, seen: Looks) -> float:
        """Probability that the text is good; a text without words scores 0."""
        if not seen.n_words:
            return 0.0
        margin = float(features(seen) @ self.weights) + self.intercept
        return 1 / (1 + math.exp(-max(min(margin, 500), -500)))


def vote_patterns(docs: DataFrame) -> DataFrame:
    """``pattern, n``: counts of vote patterns over all rows of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tally: dict[str, int] = {}
            for value in batch.column(0):
                pattern = "".join(map(str, votes(look(value.as_py() or ""))))
                tally[pattern] = tally.get(pattern, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([*tally], pa.string()), pa.array([*tally.values()], pa.int64())], ["pattern", "n"])

    counted = docs.select(F.col("text").cast("string")).mapInArrow(count, "pattern string, n bigint")
    return counted.groupBy("pattern").agg(F.sum("n").alias("n"))


def train_scorer(docs: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[Scorer, LabelModel]:
    """Label model of all rows and the scorer fitted on about ``fit_rows`` of them.

    The driver gets the counts of vote patterns, of which there are 3^9 at most, and the
    coefficients. A table without good or without bad texts gives a constant scorer.
    """
    patterns = {r["pattern"]: r["n"] for r in vote_patterns(docs).collect()}
    model = fit_label_model(patterns)

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, weights, vectors = [], [], []
            for value in batch.column(0):
                seen = look(value.as_py())
                good = model.posterior("".join(map(str, votes(seen))))
                labels.append(float(good >= 0.5))
                weights.append(abs(2 * good - 1))
                vectors.append(features(seen))
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels), pa.array(weights), pa.array(vectors, pa.list_(pa.float64()))],
                ["label", "weight", "features"])

    # A draw per id picks the share of documents that comes to the bound; the limit holds
    # where one id is repeated without end.
    share = min(1.0, fit_rows / max(sum(patterns.values()), 1))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(2**32)) / F.lit(float(2**32))
    chosen = docs.where((draw < share) & F.col("text").rlike(r"\S")).select("text").limit(2 * fit_rows)
    rows = spool(
        chosen.repartition(8).mapInArrow(labelled, "label double, weight double, features array<double>"),
        "quality-fit").where("weight > 0")
    rows = rows.select("label", "weight", array_to_vector("features").alias("features"))
    classes = {r["label"] for r in rows.select("label").distinct().collect()}
    if len(classes) < 2:
        constant = 40.0 if classes != {0.0} else -40.0
        return Scorer(np.zeros(BUCKETS), constant), model
    fitted = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=60).fit(rows)
    return Scorer(fitted.coefficients.toArray(), fitted.intercept), model


def classify_quality(docs: DataFrame, fit_rows: int = FIT_ROWS,
                     threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, kept``: every document with the probability that it is good.

    ``kept`` is true from ``threshold`` on. Null, empty and blank texts score 0. Repeated
    rows get a row each, an empty table none; other columns are not looked at.
    """
    scorer, _ = train_scorer(docs, fit_rows)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [scorer.score(look(value.as_py() or "")) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()),
                 pa.array([s >= threshold for s in scores], pa.bool_())], ["doc_id", "score", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        judge, f"doc_id {kind}, score double, kept boolean")


def keep_quality(docs: DataFrame, fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns.

    Each row is judged by its own text as it passes, so rows that share an id, or have
    none, do not speak for each other, and nothing is joined.
    """
    scorer, _ = train_scorer(docs, fit_rows)
    place = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [scorer.score(look(value.as_py() or "")) >= threshold for value in batch.column(place)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
