"""Exact top-k search by BM25 with block-max WAND over an inverted index in shards.

Every task that reads documents writes shards of the index: postings sorted by term and
document, in rows of bounded size. Documents of a shard are ordered so that neighbours are
alike (same most frequent term, like length, so copies meet), and every term has its
largest impact in each block of neighbouring documents. Document counts per term and
lengths are summed up from the shards, so all of them weigh alike.

Queries travel in batches of bounded size to the shards, where those that are alike are
searched together. The cursors of a query's terms meet in blocks: a seldom term's postings
bound its share in a document by themselves, a frequent term does so by its block maxima,
for all queries of a group in one product of matrices. Blocks whose summed bound reaches
the k-th best score so far are pivots, and only these get the frequent terms' own impacts.
The highest bounds go first and set the threshold, and a task takes a query's threshold
along from shard to shard. What remains is scored in full, and the shards' results are
merged by score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabproof.llm.near_dedup import WordHashes
from tabproof.llm.spool import spool, spool_parts

K1, B = 1.2, 0.75
TOP = 10
#: Most documents of a shard and characters of their texts, one document more or less. A
#: task may end a shard earlier. Places of documents are stored in 16 bits.
SHARD_DOCS = 16_384
SHARD_CHARS = 32_000_000
#: Documents of a block, and the least number of blocks that are scored first to set a threshold.
BLOCK = 4
STEP = 16
#: A term in more than one of so many documents of a shard has block maxima, unless these
#: terms times documents are more than so many cells: then the most frequent ones have.
OFTEN = 20
CELLS = 8_000_000
#: Queries searched together, and those whose postings are added up together.
TOGETHER = 128
ADDED = 4
#: A query's pivots are scored by themselves if the pivots of all queries searched together
#: are more than so many times the queries' own.
APART = 16
#: Terms of the queries that go to the shards together, of 16 bytes each, and the number of
#: these queries. A query's terms stay together.
BATCH_TERMS = 1_500_000
BATCH_QUERIES = 20_000
#: Tasks per core that search the shards: each takes thresholds along through its share.
TASKS = 2

_TERM = re.compile(r"\w+")
#: Bounds are sums of 32-bit numbers in another order, so they may be off by this share.
_SLACK = 1e-4


class _Codes(dict):
    """Numbers words from 0 in the order in which they come."""

    def __missing__(self, word: str) -> int:
        value = self[word] = len(self)
        return value


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _rank(hit: tuple) -> tuple:
    score, id_ = hit
    return -score, id_ is None, id_ or 0


def terms_of(text: str, hashes: WordHashes) -> np.ndarray:
    """Distinct terms: 64-bit hashes of lower-case words, sorted."""
    return np.unique(hashes.of(_TERM.findall(text.lower())).view(np.int64))


class ShardBuilder:
    """Collects documents and turns them into one row of the index."""

    FIELDS = ("ids array<bigint>, terms array<bigint>, sizes array<int>, "
              "lengths binary, post_docs binary, post_counts binary, documents bigint, tokens bigint")

    def __init__(self, hashes: WordHashes) -> None:
        self.hashes, self.words, self.ids, self.parts, self.chars = hashes, _Codes(), [], [], 0

    def add(self, id_: int | None, text: str) -> None:
        words = _TERM.findall(text.lower())
        self.parts.append(np.fromiter(map(self.words.__getitem__, words), np.int64, len(words)))
        self.ids.append(id_)
        self.chars += len(text)

    def row(self) -> tuple:
        n = len(self.ids)
        lengths = np.array([len(p) for p in self.parts], np.int64)
        terms = self.hashes.of(list(self.words)).view(np.int64)
        # Words of one hash are one term.
        terms, rank = np.unique(terms, return_inverse=True)
        keys = rank[np.concatenate(self.parts)] * n + np.repeat(np.arange(n), lengths)
        keys, counts = np.unique(keys, return_counts=True)
        of_term, docs = np.divmod(keys, n)
        leading = np.zeros(n, np.int64)
        np.maximum.at(leading, docs, (counts << 32) + of_term)
        place = np.empty(n, np.int64)
        order = np.lexsort((lengths, leading & 0xFFFFFFFF))
        place[order] = np.arange(n)
        docs = place[docs]
        by_term = np.argsort(of_term * n + docs)
        return ([self.ids[i] for i in order], terms, np.bincount(of_term, minlength=len(terms)).astype(np.int32),
                lengths[order].astype("<u4").tobytes(), docs[by_term].astype("<u2").tobytes(),
                counts[by_term].astype("<u4").tobytes(), n, int(lengths.sum()))


class Asked:
    """Queries of a batch: their terms as places in one sorted list, each with its weight.

    A term weighs the same in all queries, and every query has terms.
    """

    def __init__(self, sizes: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> None:
        self.sizes, self.ends = sizes, np.append(0, np.cumsum(sizes))
        self.terms, first, codes = np.unique(terms, return_index=True, return_inverse=True)
        self.weights, self.codes = weights[first], codes.astype(np.int32)
        rank = np.empty(len(first), np.int32)
        rank[np.argsort(self.weights, kind="stable")] = np.arange(len(first))
        #: Queries in an order in which neighbours are alike: same most frequent term, like size.
        self.order = np.lexsort((sizes, np.minimum.reduceat(rank[self.codes], self.ends[:-1])))

    def __len__(self) -> int:
        return len(self.order)


class Shard:
    """Postings of some documents, maxima of terms in blocks, and the documents' own terms."""

    def __init__(self, ids: list, terms: np.ndarray, sizes: np.ndarray, lengths: np.ndarray,
                 docs: np.ndarray, counts: np.ndarray, mean_length: float, block: int) -> None:
        self.ids, self.terms, self.sizes, self.block = ids, terms, sizes, block
        norm = K1 * (1 - B + B * lengths / max(mean_length, 1e-9))
        self.impacts = counts * (K1 + 1) / (counts + norm[docs])
        self.starts = np.append(0, np.cumsum(sizes, dtype=np.int64))
        self.blocks = -(-len(ids) // block)
        # A block is a column of a table of documents, so that a row has one of each block.
        self.spots = ((docs % block).astype(np.int64) * self.blocks + docs // block).astype(np.uint16)
        self.often = np.flatnonzero(sizes * OFTEN > len(ids))
        most = CELLS // max(1, block * self.blocks)
        if len(self.often) > most:
            self.often = np.sort(self.often[np.argsort(sizes[self.often], kind="stable")[len(self.often) - most:]])
        self.row = np.full(len(terms), -1, np.int32)
        self.row[self.often] = np.arange(len(self.often))
        at = _ranges(self.starts[self.often], sizes[self.often])
        own = np.zeros((block * self.blocks, len(self.often)), np.float32)
        own[self.spots[at], np.repeat(np.arange(len(self.often)), sizes[self.often])] = self.impacts[at]
        self.own = own.reshape(block, self.blocks, len(self.often))
        self.maxima = self.own.max(0)
        by_doc = np.argsort(docs, kind="stable")
        self.own_terms = np.repeat(np.arange(len(terms), dtype=np.int32), sizes)[by_doc]
        self.own_impacts = self.impacts[by_doc]
        self.own_starts = np.append(0, np.cumsum(np.bincount(docs, minlength=len(ids))))
        self.weights = np.zeros(len(terms))
        #: Documents of pivots whose scores were added up, once for each query.
        self.scored = 0

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int,
               threshold: float = 0.0) -> list[tuple[float, object]]:
        """The k best documents with a score above 0 and not below ``threshold``: score and
        id, ties by id."""
        if not len(terms):
            return []
        return self.search_all(Asked(np.array([len(terms)]), terms, weights), k, np.array([threshold]))[0]

    def search_all(self, asked: Asked, k: int, thresholds: np.ndarray) -> list[list[tuple[float, object]]]:
        """The same for every query of a batch."""
        out: list[list[tuple]] = [[] for _ in range(len(asked))]
        if not len(self.terms):
            return out
        found = np.minimum(np.searchsorted(self.terms, asked.terms), len(self.terms) - 1)
        at = np.where(self.terms[found] == asked.terms, found, -1)
        weights = np.zeros(len(self.terms))
        weights[at[at >= 0]] = asked.weights[at >= 0]
        shares = (self.impacts * np.repeat(weights, self.sizes)).astype(np.float32)
        for first in range(0, len(asked), TOGETHER):
            queries = asked.order[first:first + TOGETHER]
            terms = at[asked.codes[_ranges(asked.ends[queries], asked.sizes[queries])]]
            query = np.repeat(np.arange(len(queries)), asked.sizes[queries])[terms >= 0]
            terms = terms[terms >= 0]
            ends = np.searchsorted(query, np.arange(len(queries) + 1))
            for i, docs in self._together(terms, query, ends, weights, shares, k, thresholds[queries]):
                # What is left holds the k best; their full scores decide.
                own, q = terms[ends[i]:ends[i + 1]], queries[i]
                self.weights[own] = weights[own]
                best = [(s, self.ids[d]) for s, d in zip(self._exact(docs).tolist(), docs.tolist(), strict=True)
                        if s >= thresholds[q]]
                self.weights[own] = 0
                out[q] = sorted(best, key=_rank)[:k]
        return out

    def _together(self, terms: np.ndarray, query: np.ndarray, ends: np.ndarray, weights: np.ndarray,
                  shares: np.ndarray, k: int, thresholds: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Number of a query, and documents among which are its k best."""
        size, width = len(thresholds), self.block * self.blocks
        row = self.row[terms]
        often = np.zeros((size, len(self.often)), np.float32)
        often[query[row >= 0], row[row >= 0]] = weights[terms[row >= 0]]
        terms, query = terms[row < 0], query[row < 0]
        known = np.empty((size, width), np.float32)
        for first in range(0, size, ADDED):
            part = slice(*np.searchsorted(query, (first, first + ADDED)))
            some = terms[part]
            lengths = self.sizes[some]
            places = _ranges(self.starts[some], lengths)
            spots = np.repeat((query[part] - first) * width, lengths) + self.spots[places]
            rows = known[first:first + ADDED]
            rows[:] = np.bincount(spots, shares[places], len(rows) * width).reshape(-1, width)
        known = known.reshape(size, self.block, self.blocks)
        bounds = often @ self.maxima.T
        bounds += known.max(1)
        least = np.maximum(thresholds * (1 - _SLACK), np.finfo(np.float32).tiny).astype(np.float32)

        def added(query: int, blocks: np.ndarray) -> np.ndarray:
            self.scored += self.block * len(blocks)
            return (known[query][:, blocks] + self.own[:, blocks] @ often[query]).reshape(-1)

        # Without a threshold the blocks with the highest bounds set one.
        step = min(self.blocks, max(STEP, 2 * k))
        for i in np.flatnonzero(thresholds <= 0):
            sums = added(i, np.argpartition(bounds[i], self.blocks - step)[self.blocks - step:])
            least[i] = max(least[i], _least(sums, k))
        pivots = bounds >= least[:, None]
        shared = np.flatnonzero(pivots.any(0))
        if pivots.sum() * APART < len(shared) * size:
            blocks = [np.flatnonzero(p) for p in pivots]
            found = [(sums := added(i, b), np.flatnonzero(sums >= least[i])) for i, b in enumerate(blocks)]
        else:
            some = shared
            if 3 * len(shared) > 2 * self.blocks:
                shared, some = np.arange(self.blocks), slice(None)
            blocks = [shared] * size
            sums = (often @ self.own[:, some].reshape(-1, len(self.often)).T).reshape(size, self.block, -1)
            sums += known[:, :, some]
            self.scored += sums.size
            sums = sums.reshape(size, -1)
            at = np.flatnonzero(sums >= least[:, None])
            cuts = np.searchsorted(at, np.arange(1, size) * sums.shape[1])
            found = [(sums[i], a - i * sums.shape[1]) for i, a in enumerate(np.split(at, cuts))]
        for i, (sums, at) in enumerate(found):
            if len(at) > k:
                at = at[sums[at] >= _least(sums[at], k)]
            if len(at):
                spot, block = np.divmod(at, len(blocks[i]))
                yield i, blocks[i][block] * self.block + spot

    def _exact(self, docs: np.ndarray) -> np.ndarray:
        """Full scores; every document adds its terms in the order of their hashes."""
        starts, ends = self.own_starts[docs], self.own_starts[docs + 1]
        terms = np.concatenate([self.own_terms[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])
        weights = self.weights[terms]
        asked = np.flatnonzero(weights != 0)
        before = np.append(0, np.cumsum(ends - starts))
        doc = np.searchsorted(before, asked, "right") - 1
        at = asked + (starts - before[:-1])[doc]
        return np.bincount(doc, weights[asked] * self.own_impacts[at], len(docs))


def _least(sums: np.ndarray, k: int) -> float:
    """What the k-th largest of some sums leaves as the least for others, 0 if there are fewer."""
    return float(np.partition(sums, len(sums) - k)[len(sums) - k]) * (1 - _SLACK) if len(sums) >= k else 0.0


def _index(docs: DataFrame, shard_docs: int, shard_chars: int) -> DataFrame:
    """One row per shard of the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        builder = ShardBuilder(hashes)

        def out() -> pa.RecordBatch:
            ids, terms, sizes, *rest = builder.row()
            lists = [pa.array([x], pa.list_(t)) for x, t in ((ids, pa.int64()), (terms, pa.int64()), (sizes, pa.int32()))]
            return pa.RecordBatch.from_arrays(
                lists + [pa.array([x]) for x in rest],
                ["ids", "terms", "sizes", "lengths", "post_docs", "post_counts", "documents", "tokens"])

        for batch in batches:
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                builder.add(id_, text.as_py() or "")
                if len(builder.ids) >= shard_docs or builder.chars >= shard_chars:
                    yield out()
                    builder = ShardBuilder(hashes)
        if builder.ids:
            yield out()

    return docs.select("doc_id", "text").mapInArrow(run, ShardBuilder.FIELDS)


def _query_terms(queries: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            bags = [terms_of(v.as_py() or "", hashes) for v in batch.column(1)]
            place = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(place)),
                 pa.array(np.concatenate(bags) if bags else np.empty(0, np.int64), pa.int64())],
                ["query_id", "term"])

    return queries.mapInArrow(run, "query_id bigint, term bigint").distinct()


def _batches(asked: DataFrame, batch_terms: int, batch_queries: int) -> DataFrame:
    """Rows of at most so many queries and terms, unless a query alone has more."""
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, parts, size = [], [], [], 0

        def out() -> pa.RecordBatch:
            terms = [np.concatenate([p[i] for p in parts]).tobytes() for i in (0, 1)]
            return pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(pa.int64())), pa.array([np.array(sizes, "<i8").tobytes()]),
                 pa.array([terms[0]]), pa.array([terms[1]])], ["ids", "sizes", "terms", "weights"])

        for batch in batches:
            for id_, terms in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = terms.values
                if parts and (size + len(values) > batch_terms or len(ids) == batch_queries):
                    yield out()
                    ids, sizes, parts, size = [], [], [], 0
                ids.append(id_)
                sizes.append(len(values))
                size += len(values)
                parts.append([values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1)])
        if parts:
            yield out()

    packed = asked.coalesce(max(1, -(-total // batch_terms))).mapInArrow(
        run, "ids array<bigint>, sizes binary, terms binary, weights binary")
    return packed.withColumn("batch", F.monotonically_increasing_id())


def _hits(index: DataFrame, batch, k: int, mean_length: float, block: int) -> DataFrame:
    """The best documents in the shards of each task for the queries of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, terms, weights = batch.value
        asked = Asked(*(np.frombuffer(x, t) for x, t in ((sizes, "<i8"), (terms, "<i8"), (weights, "<f8"))))
        best: list[list[tuple]] = [[] for _ in ids]
        for rows in batches:
            for i in range(rows.num_rows):
                ids_, terms_, sizes_ = (rows.column(c)[i].values for c in range(3))
                lengths, docs, counts = (
                    np.frombuffer(rows.column(c)[i].as_py(), t) for c, t in ((3, "<u4"), (4, "<u2"), (5, "<u4")))
                shard = Shard(ids_.to_pylist(), terms_.to_numpy(), sizes_.to_numpy(), lengths, docs, counts,
                              mean_length, block)
                thresholds = np.array([so_far[-1][0] if len(so_far) == k else 0.0 for so_far in best])
                for q, hits in enumerate(shard.search_all(asked, k, thresholds)):
                    if hits:
                        best[q] = sorted(best[q] + hits, key=_rank)[:k]
                # One shard at a time is in memory.
                del shard
        found = [(id_, d, s) for id_, hits in zip(ids, best, strict=True) for s, d in hits]
        columns = [*zip(*found, strict=True)] or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
             pa.array(columns[2], pa.float64())], ["query_id", "doc_id", "score"])

    columns = index.select("ids", "terms", "sizes", "lengths", "post_docs", "post_counts")
    tasks = TASKS * index.sparkSession.sparkContext.defaultParallelism
    return columns.coalesce(tasks).mapInArrow(run, "query_id bigint, doc_id bigint, score double")


def search(docs: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """``query_id, rank, doc_id, score``: the k best documents of every query.

    ``docs`` has ``doc_id, text``, ``queries`` has ``query_id, text``; other columns are not
    looked at. Terms are lower-case runs of word characters; a term counts once in a query.
    Scores are BM25 over all documents, with ties ranked by id, null last. Documents that
    share no term with the query, and so have no score, are no results. Null counts as
    empty. Queries that repeat an id are joined to one. Empty tables give no rows. Terms
    are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    queries = queries.select(
        F.col("query_id").cast("bigint").alias("query_id"), F.col("text").cast("string").alias("text"))
    index = spool(_index(docs, SHARD_DOCS, SHARD_CHARS), "search-index")
    totals = index.agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).first()
    documents = totals["documents"] or 0
    mean_length = totals["tokens"] / documents if documents else 0.0
    counts = index.select(F.inline(F.arrays_zip("terms", "sizes"))).groupBy(F.col("terms").alias("term")).agg(
        F.sum("sizes").alias("documents"))
    weight = F.log1p((F.lit(float(documents)) - F.col("documents") + 0.5) / (F.col("documents") + 0.5))
    asked = spool(_query_terms(queries).join(counts, "term").groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("term", weight.alias("weight")))).alias("terms")), "search-queries")
    batches = spool(_batches(asked, BATCH_TERMS, BATCH_QUERIES), "search-batches")

    def parts() -> Iterator[DataFrame]:
        for row in batches.select("batch").collect():
            one = batches.where(F.col("batch") == row["batch"]).first()
            sent = spark.sparkContext.broadcast(
                (one["ids"], bytes(one["sizes"]), bytes(one["terms"]), bytes(one["weights"])))
            yield _hits(index, sent, k, mean_length, BLOCK)
            sent.destroy()

    hits = spool_parts(spark, parts(), "query_id bigint, doc_id bigint, score double", "search-hits")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = hits.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")
