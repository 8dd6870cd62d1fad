import hashlib
import random

import numpy as np
import pytest

from tabproof.llm import substring_dedup
from tabproof.llm.substring_dedup import remove_repeats, repeat_digests
from tabproof.llm.suffix_array import sorted_rows, suffix_array


@pytest.mark.parametrize("letters", [1, 2, 3, 50])
def test_suffix_array_equals_sorting(letters):
    rng = random.Random(letters)
    for _ in range(300):
        text = [rng.randrange(letters) - 1 for _ in range(rng.randrange(40))] * rng.choice([1, 1, 3])
        expected = sorted(range(len(text)), key=lambda i: text[i:])
        assert suffix_array(np.array(text, np.int64)).tolist() == expected


def test_sorted_rows():
    rows = np.random.default_rng(1).integers(0, 3, (500, 16)).astype(np.uint8)
    ordered = [bytes(r) for r in rows[sorted_rows(rows)]]
    assert ordered == sorted(bytes(r) for r in rows)


def brute(rows):
    """Every string of 100 bytes against all that start before it."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 99):
            part = data[k:k + 100]
            if part in seen:
                gone[k:k + 100] = b"\1" * 100
            seen.add(part)
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def crossing_rows():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdé", k=rng.randint(1, 6))) for _ in range(30)]

    def some(n):
        return " ".join(rng.choices(words, k=n))

    passages = [some(60) for _ in range(4)]
    rows = []
    for i in range(250):
        passage = rng.choice(passages)
        at, size = rng.randrange(len(passage) - 90), rng.choice([90, 98, 99, 100, 101, 120, 200])
        text = some(rng.randrange(50)) + passage[at:at + size] + some(rng.randrange(50))
        if i % 11 == 0:
            text = rng.choice(["", None, "a" * rng.randrange(50, 600), "ab" * 200, "é" * 120, "\0" * 300, passage])
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("order_rows", [20_000, 5])
def test_equals_brute_force(spark, monkeypatch, order_rows):
    monkeypatch.setattr(substring_dedup, "ORDER_ROWS", order_rows)
    rows = crossing_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = repeat_digests(docs)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows)


def test_awkward_rows(docs, rows, no_docs):
    """Rows equal in id and text share a result, so they are put in once for comparison."""
    once = {(r[0], r[1]) for r in rows}
    expected = {(r[0], r[1]): r[2:] for r in brute(once)}
    found = repeat_digests(docs).collect()
    assert len(found) == len(rows)
    for row in found:
        if row["doc_id"] is not None:
            assert tuple(row)[2:] == expected[row["doc_id"], row["n_bytes"]]
    assert repeat_digests(no_docs).count() == 0
    texts = {r["doc_id"]: r["text"] for r in remove_repeats(docs).collect()}
    assert texts[2] == "" and texts[5] == "" and texts[12] == "x"


@pytest.mark.parametrize("parts", [1, 4])
def test_repeated_rows_keep_their_first_occurrence(spark, parts):
    """Long texts under one id, alone and beside other documents that share parts of them."""
    rows = [r for r in crossing_rows()[:60] if r[1]]
    rng = random.Random(3)
    rows.append((1000, "".join(rng.choices("abcdefgh", k=700))))
    expected = {(r[0], r[1]): r[2:] for r in brute(rows)}
    docs = spark.createDataFrame(rows * 3, "doc_id bigint, text string").repartition(parts)
    found = repeat_digests(docs).collect()
    assert len(found) == 3 * len(rows)
    for row in found:
        assert tuple(row)[2:] == expected[row["doc_id"], row["n_bytes"]]
    assert expected[1000, 700][0] == 0
