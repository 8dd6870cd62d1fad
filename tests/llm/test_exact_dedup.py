import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tabproof.llm.exact_dedup import drop_exact_duplicates, exact_duplicates


def by_hand(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", "", text or "")].append((doc_id, text or ""))
    out = []
    for norm, members in groups.items():
        longest, keep = min((-len(t), i if i is not None else 2**70) for i, t in members)
        keep = None if keep == 2**70 else keep
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(i, keep, len(members), i == keep and len(t) == -longest, sha) for i, t in members]
    return sorted(out, key=repr)


@pytest.mark.parametrize("weak", [False, True])
def test_equals_brute_force(docs, rows, weak):
    """A digest of one hexadecimal digit collides all the time and changes nothing."""
    found = exact_duplicates(docs, lambda c: F.substring(F.md5(c), 1, 1)) if weak else exact_duplicates(docs)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == by_hand(rows)


def test_ids_at_the_ends_of_the_range(spark):
    rows = [(2**63 - 1, "a"), (-(2**63), "a"), (0, "a"), (None, "b"), (2**63 - 1, "b")]
    found = {r["doc_id"]: r["keep_id"] for r in exact_duplicates(
        spark.createDataFrame(rows, "doc_id bigint, text string")).where("doc_id IS NOT NULL").collect()}
    assert found[0] == -(2**63)
    keeps = exact_duplicates(spark.createDataFrame(rows[3:], "doc_id bigint, text string")).collect()
    assert {r["keep_id"] for r in keeps} == {2**63 - 1}


def test_stage_keeps_columns_and_drops_repeats(docs, rows):
    left = drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    kept = {r[0] for r in by_hand(rows) if r[3]}
    assert sorted((r["doc_id"] for r in left.collect()), key=repr) == sorted(kept, key=repr)


def test_empty(no_docs):
    assert exact_duplicates(no_docs).count() == 0
    assert drop_exact_duplicates(no_docs).count() == 0


def test_texts_that_share_an_id_are_told_apart(spark):
    rows = [(None, "one"), (None, "two"), (None, "two"), (7, "three"), (7, "four"), (1, "five x"), (8, "fivex"),
            (8, "six"), (9, "a b"), (9, "ab")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    left = sorted(map(tuple, drop_exact_duplicates(docs).collect()), key=repr)
    assert left == sorted([(None, "one"), (None, "two"), (7, "three"), (7, "four"), (1, "five x"), (8, "six"),
                           (9, "a b")], key=repr)
