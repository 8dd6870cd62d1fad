"""Near duplicates by BagMinHash signatures, banding and exact multiset overlap.

A text is the multiset of its runs of five words. BagMinHash lets every element send out
a Poisson process of points, hierarchically over the discretised weight: one process for
the first copy and one for each further power of two of copies, thinned to the copies that
exist. Each point falls on one of 128 registers and a register keeps its first point, so
two registers agree with the probability of the weighted Jaccard similarity. Points come
in the order of time and nothing is drawn after all registers are full.

Texts with equal multisets are one node from the start, told by a 128-bit digest. Nodes
that agree in a band of four registers are candidates. In every bucket each node is paired
with the bucket's most central one, that is the one whose buckets are the largest: the
text that others were copied from agrees with each of them more often than they do among
themselves. Signatures sort out what is far below the threshold, and texts decide. Where a
bucket still holds unconnected nodes after that, those are compared with each other too,
in blocks that give out no more than the links they find. Classes are the connected components of the verified pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabproof.llm.components import connected_components
from tabproof.llm.spool import spool

WORDS = 5
REGISTERS = 128
BAND = 4
#: Similarity as a fraction, so that the comparison is exact: 4/5.
SIMILAR = (4, 5)
#: Share of agreeing registers below which a pair is left out: four standard deviations
#: under the threshold.
LEAST_AGREEING = 0.66
#: Shingles drawn together, and unconnected nodes of a bucket compared in one block. Both
#: bound memory and change no result.
CHUNK = 400_000
BLOCK = 2048

_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit number for each 64-bit number."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHashes(dict):
    """64-bit hash of each word asked for; starts anew when it has grown large."""

    def __missing__(self, word: str) -> int:
        value = self[word] = int.from_bytes(
            blake2b(word.encode("utf-8", "replace"), digest_size=8).digest(), "little")
        return value

    def of(self, words: list[str]) -> np.ndarray:
        if len(self) > 500_000:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingles(text: str, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of five words (as 64-bit hashes, sorted) and how often each occurs.

    A text of one to four words has one run, all of it; a text without words has none.
    """
    words = hashes.of(text.split())
    if not len(words):
        return words, np.empty(0, np.int64)
    if len(words) < WORDS:
        words = np.concatenate([words, np.full(WORDS - len(words), len(words), np.uint64)])
    size = len(words) - WORDS + 1
    runs = np.zeros(size, np.uint64)
    for i in range(WORDS):
        runs = _mix(runs + words[i:i + size] + _GOLDEN)
    return np.unique(runs, return_counts=True)


def multiset_digest(elements: np.ndarray, counts: np.ndarray) -> bytes:
    return blake2b(elements.tobytes() + counts.astype("<i8").tobytes(), digest_size=16).digest()


def signatures(bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """BagMinHash of multisets (none of them empty): ``len(bags) x 128`` 64-bit registers."""
    out = np.zeros((len(bags), REGISTERS), np.uint64)
    todo, horizon = np.arange(len(bags)), 3.0
    while len(todo):
        filled = np.zeros(len(bags) * REGISTERS, bool)
        start = 0
        while start < len(todo):
            stop, size = start, 0
            while stop < len(todo) and (size == 0 or size + len(bags[todo[stop]][0]) <= CHUNK):
                size += len(bags[todo[stop]][0])
                stop += 1
            _draw(bags, todo[start:stop], horizon, out.reshape(-1), filled)
            start = stop
        empty = ~filled.reshape(len(bags), REGISTERS)[todo].all(1)
        todo, horizon = todo[empty], horizon * 4
    return out


def _draw(bags, chosen: np.ndarray, horizon: float, out: np.ndarray, filled: np.ndarray) -> None:
    """Points of the chosen bags up to a time at which all registers are likely full."""
    elements = np.concatenate([bags[i][0] for i in chosen])
    counts = np.concatenate([bags[i][1] for i in chosen])
    owner = np.repeat(chosen, [len(bags[i][0]) for i in chosen])
    weight = np.array([bags[i][1].sum() for i in chosen], float)
    limit = np.repeat(REGISTERS * (np.log(REGISTERS) + horizon) / weight, [len(bags[i][0]) for i in chosen])
    # Interval 0 is the first copy; interval k the copies 2^(k-1) to 2^k - 1 above it.
    intervals = np.where(counts > 1, np.floor(np.log2(np.maximum(counts - 1, 1))).astype(np.int64) + 2, 1)
    row = np.repeat(np.arange(len(elements)), intervals)
    k = np.arange(len(row)) - np.repeat(np.cumsum(intervals) - intervals, intervals)
    first = np.where(k > 0, 1 << np.maximum(k - 1, 0), 0)
    rate = np.maximum(first, 1).astype(float)
    state = _mix(elements[row] ^ _mix(k.astype(np.uint64) * _GOLDEN + _U(1)))
    time = np.zeros(len(row))
    keys, times, marks = [], [], []
    while len(row):
        state = state + _GOLDEN
        draw = _mix(state)
        time = time - np.log(((draw >> _U(11)).astype(float) + 1.0) * 2.0**-53) / rate
        alive = time <= limit[row]
        row, k, first, rate, state, time, draw = (
            x[alive] for x in (row, k, first, rate, state, time, draw))
        place = _mix(draw ^ _U(0x5851F42D4C957F2D))
        register = (place & _U(REGISTERS - 1)).astype(np.int64)
        copy = first + np.floor((place >> _U(11)).astype(float) * 2.0**-53 * rate).astype(np.int64)
        there = copy < counts[row]
        keys.append((owner[row] * REGISTERS + register)[there])
        times.append(time[there])
        marks.append(draw[there])
    key, time, mark = (np.concatenate(x) for x in (keys, times, marks))
    late_first = np.argsort(-time, kind="stable")
    out[key[late_first]] = mark[late_first]  # the earliest is written last
    filled[key] = True


def similar(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> bool:
    """Whether the multiset overlap of two texts reaches the threshold."""
    if not len(a[0]) or not len(b[0]):
        return len(a[0]) == len(b[0])
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    shared = int(np.where(b[0][at] == a[0], np.minimum(a[1], b[1][at]), 0).sum())
    return SIMILAR[1] * shared >= SIMILAR[0] * (int(a[1].sum()) + int(b[1].sum()) - shared)


def _band_keys(marks: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of signatures of 16 bits per register."""
    bands = np.ascontiguousarray(marks).view("<u8").astype(np.uint64)
    return _mix(bands + np.arange(bands.shape[1], dtype=np.uint64) * _GOLDEN).view(np.int64)


def _row_key() -> Column:
    """A key of id and text together; rows that repeat both have the same."""
    return F.unhex(F.sha2(F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
        F.coalesce(F.col("text").cast("string"), F.lit(""))), 256))


def _sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, row, digest, near, marks``; the last two only at the first row of a digest
    in a task. ``row`` is the key of id and text, ``near`` is the head of the digest,
    ``marks`` holds 16 bits per register."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        for batch in batches:
            digests, bags, at = [], [], []
            for i, value in enumerate(batch.column(1)):
                bag = shingles(value.as_py() or "", hashes)
                digest = multiset_digest(*bag)
                digests.append(digest)
                if len(bag[0]) and digest not in seen:
                    seen.add(digest)
                    bags.append(bag)
                    at.append(i)
            marks = (signatures(bags) & _U(0xFFFF)).astype("<u2")
            near, column = [None] * len(digests), [None] * len(digests)
            for row, i in enumerate(at):
                near[i] = int.from_bytes(digests[i][:8], "little", signed=True)
                column[i] = marks[row].tobytes()
            if len(seen) > 1_000_000:
                seen.clear()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(digests, pa.binary()), pa.array(near, pa.int64()),
                 pa.array(column, pa.binary())], ["doc_id", "row", "digest", "near", "marks"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string"), _row_key().alias("row")).mapInArrow(
        run, f"doc_id {kind}, row binary, digest binary, near bigint, marks binary")


def _keys(nodes: DataFrame) -> DataFrame:
    """``near, key``: a row for each node and band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(-1, REGISTERS)
            near = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(near, REGISTERS // BAND)), pa.array(_band_keys(marks).reshape(-1))],
                ["near", "key"])

    return nodes.select("near", "marks").mapInArrow(run, "near bigint, key bigint")


def _buckets(nodes: DataFrame) -> DataFrame:
    """``key, near, pivot``: members of the buckets with several nodes, and the central one."""
    keys = _keys(nodes)
    shared = keys.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("near").alias("low"), F.max("near").alias("high"))
    shared = shared.where("low != high").select(F.col("key").alias("of_key"), "n")
    members = spool(keys.join(shared, F.col("key") == F.col("of_key")).select("key", "near", "n"),
                    "near-members")
    central = members.groupBy(F.col("near").alias("of_near")).agg(F.sum("n").alias("weight"))
    weighed = members.join(central, F.col("near") == F.col("of_near")).select("key", "near", "weight")
    pivots = weighed.groupBy(F.col("key").alias("of_key")).agg(
        F.max_by("near", F.struct("weight", "near")).alias("pivot"))
    return spool(members.join(pivots, F.col("key") == F.col("of_key")).select("key", "near", "pivot"),
                 "near-buckets")


def _likely_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``a, b, agreeing`` (digests, a < b) of the pairs of heads whose registers agree enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS)
                     for c in ("a_marks", "b_marks")]
            agreeing = (sides[0] == sides[1]).mean(1)
            keep = pa.array(agreeing >= LEAST_AGREEING)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(keep), batch.column("b").filter(keep),
                 pa.array(agreeing).filter(keep)], ["a", "b", "agreeing"])

    one = nodes.select(F.col("near").alias("a_near"), F.col("digest").alias("a"), F.col("marks").alias("a_marks"))
    two = nodes.select(F.col("near").alias("b_near"), F.col("digest").alias("b"), F.col("marks").alias("b_marks"))
    joined = pairs.join(one, "a_near").join(two, "b_near").where("a != b")
    found = joined.select("a", "b", "a_marks", "b_marks").mapInArrow(run, "a binary, b binary, agreeing double")
    return found.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(
        F.max("agreeing").alias("agreeing"))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``a, b`` of the pairs whose texts are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            keep = [similar(shingles(x.as_py(), hashes), shingles(y.as_py(), hashes))
                    for x, y in zip(batch.column("a_text"), batch.column("b_text"), strict=True)]
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    one = texts.select(F.col("digest").alias("a"), F.col("text").alias("a_text"))
    two = texts.select(F.col("digest").alias("b"), F.col("text").alias("b_text"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "a_text", "b_text")
    return joined.mapInArrow(run, "a binary, b binary")


def _texts_of(docs: DataFrame, digests: DataFrame) -> DataFrame:
    """``digest, text``: one text for each of ``digests``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        for batch in batches:
            keep, found = [], []
            for value in batch.column(0):
                digest = multiset_digest(*shingles(value.as_py(), hashes))
                keep.append(digest not in seen)
                if digest not in seen:
                    seen.add(digest)
                    found.append(digest)
            if len(seen) > 1_000_000:
                seen.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), batch.column(0).filter(pa.array(keep, pa.bool_()))],
                ["digest", "text"])

    every = docs.where("text IS NOT NULL").select(F.col("text").cast("string")).mapInArrow(
        run, "digest binary, text string")
    return every.join(digests, "digest", "left_semi").dropDuplicates(["digest"])


class _Joined:
    """Which of the given groups have become one."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (above := self.parent.get(x, x)) != x:
            self.parent[x] = self.parent.get(above, above)
            x = above
        return x

    def join(self, a: int, b: int) -> None:
        self.parent[self.find(a)] = self.find(b)


def _block_links(key: int, rows: list[tuple], hashes: WordHashes) -> list[tuple[bytes, bytes]]:
    """Links between the two parts of a block that join what no link joins yet.

    Pairs go from the most to the least similar signatures, so that most of them are joined
    before their turn and only the others are compared word by word.
    """
    part = np.array([r[0] for r in rows])
    digests, texts = [r[1] for r in rows], [r[4] for r in rows]
    component = np.array([r[2] for r in rows], np.int64)
    marks = np.frombuffer(b"".join(r[3] for r in rows), "<u2").reshape(-1, REGISTERS)
    band = int((_band_keys(marks[:1])[0] == key).argmax())
    left, right = np.flatnonzero(part == part.min()), np.flatnonzero(part == part.max())
    found = []
    for i in left:
        there = right[component[right] != component[i]]
        if part.min() == part.max():
            there = there[there > i]
        equal = marks[there] == marks[i]
        agreeing = equal.mean(1)
        keep = agreeing >= LEAST_AGREEING
        there, equal, agreeing = there[keep], equal[keep], agreeing[keep]
        # A pair shares many buckets; it is looked at in the first of them.
        keep = equal.reshape(len(there), REGISTERS // BAND, BAND).all(2).argmax(1) == band
        found.append(np.stack([np.full(keep.sum(), i), there[keep], -1000 * agreeing[keep]], 1).astype(np.int64))
    pairs = np.concatenate(found) if found else np.empty((0, 3), np.int64)
    bags: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    joined, links = _Joined(), []
    for i, j, _ in pairs[np.argsort(pairs[:, 2], kind="stable")].tolist():
        a, b = int(component[i]), int(component[j])
        if digests[i] == digests[j] or joined.find(a) == joined.find(b):
            continue
        for x in (i, j):
            if x not in bags:
                bags[x] = shingles(texts[x], hashes)
        if similar(bags[i], bags[j]):
            joined.join(a, b)
            links.append((min(digests[i], digests[j]), max(digests[i], digests[j])))
    return links


def _crossing_links(buckets: DataFrame, components: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """``a, b``: links inside buckets between what the links so far leave apart."""
    placed = nodes.select("near", "digest").join(
        components.select(F.col("node").alias("digest"), "component"), "digest").select(
        F.col("near").alias("of_near"), F.xxhash64("component").alias("component")).distinct()
    # Pairs with the pivot have been looked at.
    placed = buckets.where("near != pivot").join(placed, F.col("near") == F.col("of_near"), "left").select(
        "key", "near", F.coalesce("component", F.xxhash64("near")).alias("component"))
    placed = spool(placed, "near-placed")
    open_ = placed.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"))
    open_ = open_.where("low != high").select(
        F.col("key").alias("of_key"), F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    members = placed.join(open_, F.col("key") == F.col("of_key")).drop("of_key")
    own = nodes.select("near", "digest", "marks").join(texts, "digest").select(
        F.col("near").alias("of_near"), "digest", "marks", "text")
    members = members.join(own, F.col("near") == F.col("of_near"))
    members = members.withColumn("part", F.pmod(F.hash("near"), F.col("parts")))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
        "part", "digest", "component", "marks", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows, hashes = None, [], WordHashes()

        def done() -> pa.RecordBatch:
            links = _block_links(block[0], rows, hashes)
            return pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in batch.schema.names]
            for key, low, high, *rest in zip(*columns, strict=True):
                if (key, low, high) != block:
                    if len(rows) > 1:
                        yield done()
                    block, rows = (key, low, high), []
                rows.append(tuple(rest))
        if len(rows) > 1:
            yield done()

    dealt = members.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return dealt.mapInArrow(run, "a binary, b binary")


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sketches of the documents, and the component of each digest that has links."""
    sketches = spool(_sketches(docs), "near-sketches")
    nodes = sketches.where("marks IS NOT NULL").select("digest", "near", "marks")
    buckets = _buckets(nodes)
    stars = buckets.where("near != pivot").select(
        F.col("pivot").alias("a_near"), F.col("near").alias("b_near")).distinct()
    likely = spool(_likely_pairs(stars, nodes), "near-likely")
    among = buckets.select("near").distinct().join(nodes.select("near", "digest"), "near").select("digest").distinct()
    texts = spool(_texts_of(docs, among), "near-texts")
    # Each node is first compared with one other: its most similar pivot.
    either = likely.select("a", "b", "agreeing").unionByName(
        likely.select(F.col("b").alias("a"), F.col("a").alias("b"), "agreeing"))
    first = either.groupBy("b").agg(F.max_by("a", F.struct("agreeing", "a")).alias("a")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = spool(_verified(first, texts), "near-links")
    components = connected_components(links, "near-components")
    rest = likely.select("a", "b").join(first, ["a", "b"], "left_anti")
    late = _verified(_unconnected(rest, components), texts).union(
        _crossing_links(buckets, components, nodes, texts))
    links = links.union(spool(late, "near-rest"))
    return sketches, connected_components(links, "near-classes")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, class_size, kept``: the near-duplicate class of every document.

    ``class_id`` is the smallest ``doc_id`` of the class and that document is ``kept``.
    Documents are linked if the multisets of their runs of five words overlap by 0.8 or
    more; classes are connected by such links. Null counts as empty, and texts without
    words are all equal. Texts of fewer than five words are linked if they have the same
    words. Repeated rows get a row each and share the verdict; a null id is kept only in a
    class without any other. An empty table gives no rows; other columns are not looked at.

    A pair at the threshold shares no band with probability 6e-8, and is left out by its
    signature with probability 4e-5; more similar pairs are safer.
    """
    sketches, components = _classes(docs)
    of_digest = sketches.groupBy("digest").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n"))
    placed = of_digest.join(
        components.select(F.col("node").alias("digest"), "component"), "digest", "left").withColumn(
        "component", F.coalesce("component", "digest"))
    classes = placed.groupBy("component").agg(
        F.min("low").alias("class_id"), F.sum("n").alias("class_size"))
    verdict = spool(placed.select("digest", "component").join(classes, "component").select(
        F.col("digest").alias("of_digest"), "class_id", "class_size"), "near-verdict")
    return sketches.select("doc_id", "digest").join(
        verdict, F.col("digest") == F.col("of_digest")).select(
        "doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def _unconnected(pairs: DataFrame, components: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component."""
    one = components.select(F.col("node").alias("a"), F.col("component").alias("a_in"))
    two = components.select(F.col("node").alias("b"), F.col("component").alias("b_in"))
    placed = pairs.join(one, "a", "left").join(two, "b", "left")
    return placed.where("a_in IS NULL OR b_in IS NULL OR a_in != b_in").select("a", "b")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, all columns.

    That is the row of the smallest id, null being the largest; texts of one id go by a
    checksum. The verdict is on id and text together, so classes that share an id, or have
    none, each keep a row.
    """
    sketches, components = _classes(docs)
    first = sketches.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    placed = first.join(components.select(F.col("node").alias("digest"), "component"), "digest", "left")
    kept = placed.groupBy(F.coalesce("component", "digest")).agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.row").alias("_kept_row"))
    staying = docs.withColumn("_row", _row_key()).join(
        kept, F.col("_row") == F.col("_kept_row"), "left_semi")
    return staying.dropDuplicates(["_row"]).drop("_row")
