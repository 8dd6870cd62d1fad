import hashlib
import re

import pytest

from tabproof.llm import decontaminate
from tabproof.llm.decontaminate import contamination, cut_contaminated, drop_contaminated, words
from tests.llm.conftest import SCHEMA, with_clashes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


def by_hand(rows, items):
    windows = {}
    for item, text in items:
        own = plain_words(text)
        n = min(10, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            windows.setdefault(tuple(own[i:i + n]), set()).add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text, *_ in rows:
        own, hit, found = plain_words(text), set(), set()
        for n in lengths:
            for i in range(len(own) - n + 1):
                ids = windows.get(tuple(own[i:i + n]))
                if ids:
                    found |= ids
                    hit |= set(range(i, i + n))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture
def leaks(words):
    """Items and documents that hold them in parts, twice, overlapping, in other case."""
    long = words(40, 900)
    items = [
        (1, long), (2, words(10, 901)), (10, "Three short words"), (3, "One"), (4, None), (5, "..."), (None, words(12, 902)),
        (7, long), (8, "Ünïcode ǅ ÀB c ß Σas ½ 漢字 i İ"), (8, words(15, 903)),
    ]
    parts = long.split()
    rows = [
        (201, "x " + long.upper() + " y", "en", "a", 1), (202, " ".join(parts[:9]), "en", "a", 1),
        (203, " ".join(parts[5:15] + ["z"] + parts[20:31]), "en", "a", 1), (204, "three, SHORT-words one", "en", "a", 1),
        (204, "another text", "en", "a", 1), (None, long, "en", "a", 1), (None, "nothing here", "en", "a", 1),
        (205, "a " + "Ünïcode ǅ ÀB c ß Σas ½ 漢字 i İ" + " ünïcode ǆ", "en", "a", 1), (206, long + " " + long, "en", "a", 1),
        (207, long, "en", "a", 1), (207, long, "en", "a", 1), (208, (long + " filler ") * 300, "en", "a", 1),
        (209, words(12, 902).replace(" ", "\n--"), "en", "a", 1),
    ]
    return items, rows


@pytest.mark.parametrize("broadcast", [0, 2**20])
def test_equals_brute_force(spark, rows, leaks, monkeypatch, broadcast):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", broadcast)
    items, more = leaks
    docs = with_clashes(spark.createDataFrame(rows + more, SCHEMA)).repartition(3)
    benchmark = with_clashes(spark.createDataFrame(items, "item_id bigint, text string"))
    found = contamination(docs, benchmark)
    assert found.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, found.collect()), key=repr) == by_hand(rows + more, items)


def test_shared_bits_remove_nothing(spark, rows, leaks, monkeypatch):
    """With 64 bits nearly every window has its bit set; the words decide."""
    items, more = leaks
    monkeypatch.setattr(decontaminate, "LEAST_BITS", 64)
    monkeypatch.setattr(decontaminate, "MOST_BITS", 64)
    docs = spark.createDataFrame(rows + more, SCHEMA)
    found = contamination(docs, spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted(map(tuple, found.collect()), key=repr) == by_hand(rows + more, items)


def test_words_keep_capitals_beyond_ascii(spark):
    texts = ["ABC abc", "ÀB ÑAm", "Σ ΑΣ", "İI", "ⒶB Ⅷ ǅx", "", None, "1a-2B", "\x00A\x7fB"]
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", words("t")).collect()
    assert {i: w for i, w in found} == {i: plain_words(t) for i, t in enumerate(texts)}


def test_removal(spark, rows, leaks):
    items, more = leaks
    docs = spark.createDataFrame(rows + more, SCHEMA).repartition(2)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    verdicts = by_hand(rows + more, items)
    clean = [v for v in verdicts if not v[5]]
    left = drop_contaminated(docs, benchmark)
    assert left.columns == docs.columns and left.count() == len(clean)
    cut = cut_contaminated(docs, benchmark)
    assert cut.columns == docs.columns
    counts = sorted((r["doc_id"], len(plain_words(r["text"]))) for r in cut.where("doc_id >= 200").collect())
    assert counts == sorted((v[0], v[1] - v[2]) for v in verdicts if v[0] and v[0] >= 200)
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert texts[201] == "x y" and texts[203] == "z " and texts[8] == rows[7][1] and texts[5] is None


def test_empty_tables(spark, docs, no_docs):
    no_items = spark.createDataFrame([], "item_id bigint, text string")
    assert contamination(no_docs, no_items).count() == 0
    found = contamination(docs, no_items)
    assert found.count() == docs.count() and found.where("contaminated OR n_items > 0").count() == 0
    assert cut_contaminated(docs, no_items).count() == drop_contaminated(docs, no_items).count() == docs.count()
