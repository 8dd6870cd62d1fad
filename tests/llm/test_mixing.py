import pytest

from tabproof.llm.mixing import mix_sources, source_targets, take_mix


def levels(sizes, weights, most):
    """Shares by weight with the excess dealt again, step by step."""
    total = sum(sizes)
    limits = [most * s for s in sizes]
    full, targets = set(), [0.0] * len(sizes)
    while True:
        free = [i for i in range(len(sizes)) if i not in full]
        rest = total - sum(limits[i] for i in full)
        for i in full:
            targets[i] = limits[i]
        for i in free:
            targets[i] = rest * weights[i % len(weights)] / sum(weights[j % len(weights)] for j in free)
        over = {i for i in free if targets[i] > limits[i]}
        if not over:
            return targets
        full |= over


@pytest.mark.parametrize("sizes", [[100, 10, 1], [5, 1000, 1000, 7], [0, 0, 3], [10] * 7, [0]])
def test_targets_are_the_fixed_point(spark, sizes):
    table = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(sizes)], "source string, source_size bigint")
    found = [r["target"] for r in source_targets(table).orderBy("source").collect()]
    assert found == pytest.approx(levels(sizes, [5, 2, 1], 3))


def test_mix(docs, rows):
    found = mix_sources(docs)
    assert found.columns == ["doc_id", "size", "source_size", "target", "taken", "copies"]
    result = sorted(map(tuple, found.collect()), key=repr)
    assert len(result) == len(rows)
    sizes = {i: len((t or "").split()) for i, t, *_ in rows if i is not None}
    for doc_id, size, source_size, target, taken, copies in result:
        assert doc_id is None or size == sizes[doc_id]
        assert 0 <= copies <= 3 and taken == copies * size and target <= 3 * source_size
    assert sorted(map(tuple, mix_sources(docs.repartition(5)).collect()), key=repr) == result


def test_taken_is_near_the_target(spark, words):
    rows = [(i, words(20 + i % 61, i), "en", ["hot", "b", "c", None][0 if i % 3 else i % 4], 1) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = mix_sources(docs).groupBy("source_size", "target").sum("taken").collect()
    for source_size, target, taken in found:
        assert abs(taken - target) <= 0.03 * target + 80


def test_stage_repeats_rows(docs, no_docs):
    copies = {r["doc_id"]: r["copies"] for r in mix_sources(docs).collect()}
    left = take_mix(docs)
    assert left.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in left.groupBy("doc_id").count().collect()}
    for doc_id, n in counts.items():
        if doc_id not in (None, 9):  # ids that stand for several rows
            assert n == copies[doc_id]
    assert mix_sources(no_docs).count() == take_mix(no_docs).count() == 0


def test_stage_takes_what_the_mix_says(spark, words):
    """Rows without id, under one id, and repeated ones: as many rows as copies in all."""
    rows = [(None, words(5 + i % 9, i), "en", "abc"[i % 3], i) for i in range(90)]
    rows += [(7, words(6 + i % 5, 200 + i), "en", "ab"[i % 2], i) for i in range(40)]
    rows += [(8, words(9, 300), "en", "a", 1)] * 5 + [(9, None, "en", None, 1), (9, "", "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    mixed = mix_sources(docs)
    assert mixed.count() == len(rows)
    left = take_mix(docs.repartition(3))
    assert left.count() == mixed.agg({"copies": "sum"}).first()[0]
    texts = {t for _, t, *_ in rows}
    assert {r["text"] for r in left.collect()} <= texts
