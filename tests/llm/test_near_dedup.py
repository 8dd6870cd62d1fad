from collections import Counter

import numpy as np
import pytest

from tabproof.llm import near_dedup
from tabproof.llm.near_dedup import drop_near_duplicates, near_duplicates, signatures


def bag(weights):
    keys = sorted(weights)
    return np.array(keys, np.uint64), np.array([weights[k] for k in keys], np.int64)


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(60):
        one = dict(zip(rng.integers(0, 2**63, 80).tolist(), rng.choice([1, 1, 1, 2, 3, 7, 20], 80).tolist(), strict=True))
        two = dict(one)
        for k in list(two)[:12]:
            two[k] = max(1, two[k] + int(rng.integers(-3, 5)))
        for k in list(two)[12:20]:
            del two[k]
        either = {*one, *two}
        exact = sum(min(one.get(k, 0), two.get(k, 0)) for k in either) / sum(
            max(one.get(k, 0), two.get(k, 0)) for k in either)
        a, b = signatures([bag(one), bag(two)])
        errors.append((a == b).mean() - exact)
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.05


def test_signatures_do_not_depend_on_company(monkeypatch):
    rng = np.random.default_rng(1)
    bags = [bag({int(k): int(c) for k, c in zip(rng.integers(0, 2**63, n), rng.integers(1, 4, n), strict=True)})
            for n in (1, 2, 5, 300, 2000)]
    together = signatures(bags)
    monkeypatch.setattr(near_dedup, "CHUNK", 10)
    assert (signatures(bags) == together).all()
    assert all((signatures([b])[0] == t).all() for b, t in zip(bags, together, strict=True))


def classes_of(rows):
    """Connected by multisets of five-word runs that overlap by 0.8."""
    bags = []
    for _, text in rows:
        words = (text or "").split()
        bags.append(Counter(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            shared = sum((bags[i] & bags[j]).values())
            whole = sum((bags[i] | bags[j]).values())
            if 5 * shared >= 4 * whole and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


@pytest.mark.parametrize("block", [2048, 2])
def test_equals_brute_force(spark, words, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows, n = [], 0
    for g in range(12):
        base = words(100 + 10 * g, g).split()
        for c in range(g):
            copy = list(base)
            for e in range(c % 4):
                copy[(17 * e + 5 * c) % len(copy)] = f"edit{g}x{c}x{e}"
            rows.append((n, " ".join(copy)))
            n += 1
    rows += [(n + i, words(60, 900 + i) + " " + words(60, 1)) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    group = classes_of(rows)
    expected = {i: min(j for (j, _), h in zip(rows, group, strict=True) if h == g)
                for (i, _), g in zip(rows, group, strict=True)}
    found = near_duplicates(docs).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == expected
    sizes = Counter(expected.values())
    assert all(r["class_size"] == sizes[r["class_id"]] and r["kept"] == (r["doc_id"] == r["class_id"]) for r in found)


def test_awkward_rows(docs, rows, no_docs):
    found = near_duplicates(docs)
    assert found.columns == ["doc_id", "class_id", "class_size", "kept"]
    result = found.collect()
    assert len(result) == len(rows)
    by_id = {r["doc_id"]: r["class_id"] for r in result}
    assert by_id[1] == by_id[2] == by_id[3] == by_id[4] == 1
    assert by_id[5] == by_id[6] == by_id[7] == 5 and by_id[9] == by_id[10] == 9
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted({c for c in by_id.values() if c is not None})
    assert near_duplicates(no_docs).count() == drop_near_duplicates(no_docs).count() == 0


def test_texts_that_share_an_id_are_told_apart(spark, words):
    """One row a class, also for classes of one id or none, and for near copies under one id."""
    base = words(120, 1)
    near = base.replace(base.split()[60], "changed", 1)
    rows = [(None, words(40, 2)), (None, words(40, 3)), (None, words(40, 3)), (7, words(40, 4)), (7, words(40, 5)),
            (1, base), (8, near), (8, words(40, 6)), (None, base), (9, ""), (10, " ")]
    near_two = words(40, 7) + " " + words(100, 8)
    rows += [(11, near_two), (11, near_two + " more")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    left = [(r["doc_id"], r["text"]) for r in drop_near_duplicates(docs).collect()]
    assert sorted((x for x in left if x[0] != 11), key=repr) == sorted(
        [rows[0], rows[1], rows[3], rows[4], rows[5], rows[7], rows[9]], key=repr)
    assert len([x for x in left if x[0] == 11]) == 1
