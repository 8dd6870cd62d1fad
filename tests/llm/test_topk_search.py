import math
import re
from collections import Counter

import numpy as np
import pytest

from tabproof.llm import topk_search
from tabproof.llm.topk_search import search


def brute(docs, queries, k):
    bags = [(i, Counter(re.findall(r"\w+", (t or "").lower()))) for i, t in docs]
    n = len(bags)
    mean = sum(sum(b.values()) for _, b in bags) / n
    found = Counter(t for _, b in bags for t in b)
    out = {}
    for query, text in queries:
        terms = {*re.findall(r"\w+", (text or "").lower())}
        scores = []
        for i, b in bags:
            norm = 1.2 * (0.25 + 0.75 * sum(b.values()) / mean)
            score = sum(math.log1p((n - found[t] + 0.5) / (found[t] + 0.5)) * b[t] * 2.2 / (b[t] + norm)
                        for t in sorted(terms & b.keys()))
            if score > 0:
                scores.append((-round(score, 9), i))
        out[query] = sorted(scores)[:k]
    return out


@pytest.mark.parametrize(("shard_docs", "block"), [(16_384, 32), (40, 3)])
def test_equals_brute_force(spark, words, monkeypatch, shard_docs, block):
    monkeypatch.setattr(topk_search, "SHARD_DOCS", shard_docs)
    monkeypatch.setattr(topk_search, "BLOCK", block)
    docs = [(i, words(5 + i % 90, i // 2 if i % 7 == 0 else i)) for i in range(300)]
    queries = [(i, t) for i, t in docs if i % 50 == 0] + [(1000, "no such term"), (1001, None), (1002, "")]
    result = search(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3),
                    spark.createDataFrame(queries, "query_id bigint, text string"), k=7)
    assert result.columns == ["query_id", "rank", "doc_id", "score"]
    found = {}
    for row in result.orderBy("query_id", "rank").collect():
        found.setdefault(row["query_id"], []).append((-round(row["score"], 9), row["doc_id"]))
    expected = {q: hits for q, hits in brute(docs, queries, 7).items() if hits}
    assert {q: [i for _, i in hits] for q, hits in found.items()} == {
        q: [i for _, i in hits] for q, hits in expected.items()}
    for query, hits in expected.items():
        assert [s for s, _ in found[query]] == pytest.approx([s for s, _ in hits])


def test_awkward_rows(spark, docs, rows, no_docs):
    queries = spark.createDataFrame([(1, "two words"), (1, "words again"), (None, "two")], "query_id bigint, text string")
    found = search(docs, queries).where("query_id = 1").orderBy("rank").collect()
    assert [r["doc_id"] for r in found][:3] == [9, 9, 10]
    assert search(no_docs, queries).count() == 0
    assert search(docs, queries.limit(0)).count() == 0


def _shard(docs, block=8):
    hashes = topk_search.WordHashes()
    builder = topk_search.ShardBuilder(hashes)
    for id_, text in docs:
        builder.add(id_, text)
    ids, terms, sizes, lengths, places, counts, documents, tokens = builder.row()
    return hashes, topk_search.Shard(
        ids, terms, sizes, np.frombuffer(lengths, "<u4"), np.frombuffer(places, "<u2"), np.frombuffer(counts, "<u4"),
        tokens / documents, block)


def test_few_documents_are_scored():
    random = np.random.default_rng(5)
    topics = [[f"topic{t}word{w}" for w in range(30)] for t in range(40)]
    docs = [(i, " ".join([*random.choice(topics[i % 40], 20), *random.choice(["the", "of", "and", "to"], 30)]))
            for i in range(4000)]
    hashes, shard = _shard(docs)
    total = len(docs)
    for id_, text in docs[:20]:
        terms = topk_search.terms_of(text, hashes)
        at = np.searchsorted(shard.terms, terms)
        found = np.diff(shard.starts)[at]
        weights = np.log1p((total - found + 0.5) / (found + 0.5))
        hits = shard.search(terms, weights, 10)
        shard.weights[at] = weights
        scores = shard._exact(np.arange(total))
        shard.weights[at] = 0
        expected = sorted(zip((-scores).tolist(), shard.ids, strict=True))[:10]
        assert hits == [(-s, i) for s, i in expected]
        # A threshold from another shard leaves out what is below it, and nothing else.
        assert shard.search(terms, weights, 10, hits[4][0]) == [h for h in hits if h[0] >= hits[4][0]]
    assert shard.scored < 0.05 * total * 40


def test_ties_take_the_smallest_ids_over_all_shards_and_batches(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "SHARD_DOCS", 7)
    monkeypatch.setattr(topk_search, "BATCH_TERMS", 5)
    docs = [(None if i == 50 else 100 - i, "same three words") for i in range(101)] + [(200 + i, f"other {i}") for i in range(40)]
    queries = [(i, text) for i, text in enumerate(["same three words", "words", "other 7", "three other", None] * 3)]
    found = search(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4),
                   spark.createDataFrame(queries, "query_id bigint, text string"), k=5)
    got = {}
    for row in found.orderBy("query_id", "rank").collect():
        got.setdefault(row["query_id"], []).append(row["doc_id"])
    assert got[0] == got[5] == got[10] == [0, 1, 2, 3, 4] == got[1]
    assert got[2][0] == 207
    assert got[3][:1] == [200] and 4 not in got


def test_a_very_long_text_is_a_shard_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "SHARD_CHARS", 1000)
    docs = [(1, "long " * 300_000 + "needle"), (2, "needle"), (3, "a needle here"), (4, ""), (5, None)]
    found = search(spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1),
                   spark.createDataFrame([(9, "needle")], "query_id bigint, text string"))
    assert [r["doc_id"] for r in found.orderBy("rank").collect()] == [2, 3, 1]


@pytest.mark.parametrize(("apart", "cells"), [(0, 8_000_000), (10**9, 8_000_000), (10**9, 1200)])
def test_queries_of_a_batch_are_searched_together(words, monkeypatch, apart, cells):
    monkeypatch.setattr(topk_search, "APART", apart)
    monkeypatch.setattr(topk_search, "CELLS", cells)
    monkeypatch.setattr(topk_search, "TOGETHER", 50)
    hashes, shard = _shard([(i, words(5 + i % 90, i)) for i in range(301)], 4)
    assert len(shard.often) > 1
    bags = [topk_search.terms_of(words(3 + i % 40, 2 * i) + " unknown", hashes) for i in range(120)]
    every = np.unique(np.concatenate(bags))
    weight = dict(zip(every.tolist(), np.random.default_rng(1).uniform(0.1, 9, len(every)), strict=True))
    weights = [np.array([weight[t] for t in bag.tolist()]) for bag in bags]
    expected = []
    for bag, own in zip(bags, weights, strict=True):
        shard.weights[:] = 0
        there = np.isin(bag, shard.terms)
        shard.weights[np.searchsorted(shard.terms, bag[there])] = own[there]
        scores = shard._exact(np.arange(301)).tolist()
        expected.append([(-s, i) for s, i in sorted(zip([-s for s in scores], shard.ids, strict=True)) if s < 0][:10])
    shard.weights[:] = 0
    asked = topk_search.Asked(np.array([len(b) for b in bags]), np.concatenate(bags), np.concatenate(weights))
    assert shard.search_all(asked, 10, np.zeros(120)) == expected
    # With thresholds that nothing reaches, what is left to do is done for several queries at once.
    calls = []
    ranges = topk_search._ranges
    monkeypatch.setattr(topk_search, "_ranges", lambda *args: calls.append(1) or ranges(*args))
    assert shard.search_all(asked, 10, np.full(120, 1e6)) == [[]] * 120
    assert len(calls) < 40
    # A threshold leaves out what is below it, and nothing else.
    thresholds = np.array([hits[4][0] for hits in expected])
    assert shard.search_all(asked, 10, thresholds) == [
        [h for h in hits if h[0] >= t] for hits, t in zip(expected, thresholds, strict=True)]
