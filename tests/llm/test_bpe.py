import hashlib
import json
import random
import time
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tabproof.llm.bpe import (
    PartitionEncoder, decode_documents, encode_documents, merge_alone, merge_words, token_digests, vocabulary,
)

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def awkward():
    rng = random.Random(5)
    letters = [chr(c) for c in range(0x3000) if chr(c).isprintable()]
    yield from ("", "<|startoftext|>Hi<|endoftext|>", "a<|endoftext|", "ΑΣ ΟΔΟΣ", "İstanbul", "e\u0301 a\u030a",
                "a" * 3000, "don't I'LL we've 'S", "\x1c\x1d a\x85b\u2003c", "½ ²3", "😀😀 漢字")
    for size in (40, 400):
        for _ in range(40):
            yield "".join(rng.choices("abcdefghij ", k=size))
            yield "".join(rng.choices("aon", k=size))
    yield from (" ".join(letters[i:i + 300]) for i in range(0, len(letters), 300))


def test_equals_the_library(library):
    encoder = PartitionEncoder(PATH)
    texts = [*awkward()]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert array("I", ids).tolist() == expected, text[:60]
        assert encoder.decode(ids).decode() == library.decode(expected, skip_special_tokens=False)


def test_long_words_equal_the_library(library):
    """Words of one or two letters, long enough that a merge per turn would not end."""
    rng = random.Random(9)
    texts = [unit * (20_000 // len(unit)) for unit in ("a", "ab", "na", "ha", "aab", "oo", "eee", "in", "the", "é", "aaaab")]
    texts += ["".join(rng.choices(letters, k=size)) for letters in ("ah", "no", "aeh", "xyz", "éa") for size in (300, 3000)]
    encoder = PartitionEncoder(PATH)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert array("I", ids).tolist() == library.encode(text, add_special_tokens=False).ids, text[:20]


def test_a_million_letters(library):
    started = time.perf_counter()
    encoder = PartitionEncoder(PATH)
    found = [array("I", ids) for ids in encoder.encode(["a" * 1_000_000, "na" * 300_000, "ha" * 50_000])]
    assert time.perf_counter() - started < 30
    assert found[2].tolist() == library.encode("ha" * 50_000, add_special_tokens=False).ids
    assert all(encoder.decode(ids.tobytes()).replace(b"</w>", b"").replace(b" ", b"")[:2] in (b"aa", b"na", b"ha") for ids in found)


def test_words_merged_alone(library):
    vocab = vocabulary(PATH)
    rng = random.Random(3)
    for size in (1, 2, 5, 50, 500):
        for letters in ("ah", "abcdefghijkl", "no"):
            word = "".join(rng.choices(letters, k=size)).encode()
            symbols = [*vocab.inner[[*word[:-1]]].tolist(), int(vocab.last[word[-1]])]
            assert merge_alone(symbols, vocab) == array("I", merge_words([word], vocab)[0]).tolist()


def test_documents(docs, rows, no_docs, library):
    found = token_digests(docs, PATH)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    expected = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((doc_id, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(),
                         hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    assert token_digests(no_docs, PATH).count() == 0


def test_round_trip(docs, rows, library):
    back = decode_documents(encode_documents(docs, PATH), PATH).collect()
    texts = {i: library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False)
             for i, t, *_ in rows if i is not None}
    assert all(r["text"] == texts[r["doc_id"]] for r in back if r["doc_id"] is not None)


@pytest.mark.parametrize("seed", range(6))
def test_merges_in_any_order(tmp_path, seed):
    """With ranks dealt at random, merges often bring forth pairs that go first."""
    rng = random.Random(seed)
    with open(PATH, encoding="utf-8") as file:
        content = json.load(file)
    few = [m for m in content["model"]["merges"] if set("".join(m).replace("</w>", "")) <= set("ahno ")]
    rng.shuffle(few)
    content["model"]["merges"] = few
    path = str(tmp_path / "shuffled.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(content, file)
    library = Tokenizer.from_file(path)
    texts = ["".join(rng.choices(letters, k=size)) for letters in ("ah", "no", "ahno", "a") for size in (3, 9, 40, 200, 255, 900)]
    texts += [unit * 700 for unit in ("a", "ah", "aah", "no", "nn", "hano")]
    encoder = PartitionEncoder(path)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert array("I", ids).tolist() == library.encode(text, add_special_tokens=False).ids, text[:40]
