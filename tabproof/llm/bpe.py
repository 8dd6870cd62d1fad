"""BPE encoding and decoding with an index of pair occurrences.

Documents never leave their partition. A task takes its documents in slices, collects the
distinct words that it has not met yet, lays their symbols end to end, and maps each
mergeable pair to all its positions. The active pair of lowest rank is merged wherever it
occurs; that touches only the lists of the pairs left and right of each merge. Words met
before come from a table, so the index works on distinct words, whatever the number of
documents.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of text whose words are indexed together, and characters of words kept in the
#: table of known words before it starts anew. Both bound memory and change no result.
SLICE_CHARS = 8_000_000
KNOWN_CHARS = 16_000_000
#: Bytes of a word from which on it is merged by itself where its places cannot be merged
#: together: turn by turn, the others of its places would be looked at again and again.
LONG_WORD = 256
#: Capitals that the tokenizer lowers and Python's tables do not know yet.
_NEW_CAPITALS = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3,
    0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
    **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}


#: Letters and digits younger than the tokenizer's tables, which it takes
#: for other characters.
_NOT_YET = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD),
    (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959),
    (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9),
    (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8),
    (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF),
    (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4),
    (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F),
)
_LATE = "[" + "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in _NOT_YET) + "]"
#: How the vocabulary splits text into words.
_WORDS = regex.compile(
    rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}--{_LATE}]+|[\p{{N}}--{_LATE}]"
    rf"|[[^\p{{White_Space}}\p{{L}}\p{{N}}]||{_LATE}]+")
#: The same for text within U+00FF, which is its own NFC form; plain classes match faster.
_LATIN_LETTERS = r"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_LATIN_DIGITS = r"0-9\xb2\xb3\xb9\xbc-\xbe"
_LATIN_WORDS = re.compile(
    rf"[{_LATIN_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN_DIGITS}]"
    rf"|[^\t-\r \x85\xa0{_LATIN_LETTERS}{_LATIN_DIGITS}]+")


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself, or one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, spare = [], 0x100
    for byte in range(256):
        if byte in shown:
            letters.append(chr(byte))
        else:
            letters.append(chr(spare))
            spare += 1
    return letters


class Vocabulary:
    """Symbols and ranked merges of a tokenizer file with word-end marks."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        ids = model["vocab"]
        suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.tokens = {i: t.encode() for t, i in (ids | self.special).items()}
        letters = _byte_letters()
        self.inner = np.array([ids[c] for c in letters], np.int64)
        self.last = np.array([ids[c + suffix] for c in letters], np.int64)
        #: By rank: left, right, merged symbol. By symbol: lowest rank of a pair it is in.
        self.merges: list[tuple[int, int, int]] = []
        self.lowest = dict.fromkeys(ids.values(), len(model["merges"]))
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.append((ids[left], ids[right], ids[left + right]))
            for symbol in (ids[left], ids[right]):
                self.lowest[symbol] = min(self.lowest[symbol], rank)
        keys = np.array([(left << 32) | right for left, right, _ in self.merges], np.int64)
        self.pair_ranks = np.argsort(keys)
        self.pairs = keys[self.pair_ranks]
        #: Ranks by pair, for words that are merged by themselves.
        self.known_ranks = {(left, right): rank for rank, (left, right, _) in enumerate(self.merges)}
        self.split_special = re.compile(
            "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)))


    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols, -1 where a pair has none."""
        keys = (left << 32) | right
        at = np.searchsorted(self.pairs, keys)
        at[at == len(self.pairs)] = 0
        return np.where(self.pairs[at] == keys, self.pair_ranks[at], -1)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_alone(symbols: list[int], vocab: Vocabulary) -> list[int]:
    """``symbols`` of one word merged to the end; the lowest rank first, then the leftmost."""
    size = len(symbols)
    following, previous = list(range(1, size)) + [-1], list(range(-1, size - 1))
    ranks = vocab.known_ranks
    heap = [(ranks[pair], i) for i, pair in enumerate(zip(symbols, symbols[1:])) if pair in ranks]
    heapq.heapify(heap)
    while heap:
        rank, at = heapq.heappop(heap)
        left, right, merged = vocab.merges[rank]
        after = following[at]
        if symbols[at] != left or after < 0 or symbols[after] != right:
            continue
        symbols[at], symbols[after] = merged, -1
        following[at] = beyond = following[after]
        if beyond >= 0:
            previous[beyond] = at
            if (found := ranks.get((merged, symbols[beyond]))) is not None:
                heapq.heappush(heap, (found, at))
        if (before := previous[at]) >= 0 and (found := ranks.get((symbols[before], merged))) is not None:
            heapq.heappush(heap, (found, before))
    return [x for x in symbols if x >= 0]


def merge_words(words: list[bytes], vocab: Vocabulary) -> list[bytes]:
    """Ids of each word (its UTF-8 bytes, not empty) as little-endian 32-bit integers."""
    if not words:
        return []
    letters = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    starts = np.concatenate([[0], ends[:-1]])
    symbols = vocab.inner[letters]
    symbols[ends - 1] = vocab.last[letters[ends - 1]]
    following = np.arange(1, len(symbols) + 1)
    following[ends - 1] = -1
    previous = np.arange(-1, len(symbols) - 1)
    previous[starts] = -1
    places: dict[int, list[int]] = {}
    active: list[int] = []

    def note(pairs_at: np.ndarray) -> None:
        """Enter the pairs that start at these positions into the index."""
        found = vocab.rank(symbols[pairs_at], symbols[following[pairs_at]])
        hit = found >= 0
        for rank, at in zip(found[hit].tolist(), pairs_at[hit].tolist(), strict=True):
            if (known := places.get(rank)) is None:
                places[rank] = [at]
                heapq.heappush(active, rank)
            else:
                known.append(at)

    def merge(at: np.ndarray, merged: int) -> None:
        """Merge the pairs at these positions, none of which overlap, and update the index."""
        after = following[at]
        symbols[at], symbols[after] = merged, -1
        beyond = following[after]
        following[at] = beyond
        open_right = beyond >= 0
        previous[beyond[open_right]] = at[open_right]
        before = previous[at]
        note(np.unique(np.concatenate([before[before >= 0], at[open_right]])))

    def brought_forth(at: np.ndarray, merged: int) -> np.ndarray:
        """Lowest rank of the two pairs that each merge makes, those on its left being done."""
        before, beyond = previous[at], following[following[at]]
        joined = np.concatenate([[False], following[following[at[:-1]]] == at[1:]])
        left = np.where(joined, merged, symbols[before])
        none = len(vocab.merges)

        def ranks(left, right, there):
            found = vocab.rank(np.broadcast_to(left, at.shape), np.broadcast_to(right, at.shape))
            return np.where(there & (found >= 0), found, none)

        return np.minimum(ranks(left, merged, before >= 0), ranks(merged, symbols[beyond], beyond >= 0))

    def finish(word: int) -> None:
        """Merge all that is left of one word by itself, place by place."""
        at = np.flatnonzero(symbols[starts[word]:ends[word]] >= 0) + starts[word]
        left = merge_alone(symbols[at].tolist(), vocab)
        symbols[starts[word]:ends[word]] = -1
        symbols[starts[word]:starts[word] + len(left)] = left
        following[starts[word]:ends[word]] = -1

    note(np.flatnonzero(following >= 0))
    while active:
        rank = heapq.heappop(active)
        left, right, merged = vocab.merges[rank]
        at = np.unique(np.array(places.pop(rank), np.int64))
        after = following[at]
        at = at[(symbols[at] == left) & (after >= 0) & (symbols[after] == right)]
        if not len(at):
            continue
        every = at
        if left == right:
            # In a run of one symbol each second place is merged, from the left.
            touches = np.concatenate([[False], at[1:] == following[at[:-1]]])
            run = np.flatnonzero(~touches)
            at = at[(np.arange(len(at)) - run[np.cumsum(~touches) - 1]) % 2 == 0]
        if vocab.lowest[merged] < rank:
            # A merge may bring forth a pair that goes before the places on its right.
            first = at[brought_forth(at, merged) < rank]
            words_of_first, order = np.unique(np.searchsorted(starts, first, side="right") - 1, return_index=True)
            ends_turn = np.full(len(starts), len(symbols))
            ends_turn[words_of_first] = first[order]
            limit, rest_limit = (ends_turn[np.searchsorted(starts, x, side="right") - 1] for x in (at, every))
            at, rest = at[at <= limit], every[every > rest_limit]
            if len(rest):
                word = np.searchsorted(starts, rest, side="right") - 1
                long = np.unique(word[ends[word] - starts[word] > LONG_WORD])
                for number in long.tolist():
                    finish(number)
                at = at[~np.isin(np.searchsorted(starts, at, side="right") - 1, long)]
                if len(rest := rest[~np.isin(word, long)]):
                    places[rank] = rest.tolist()
                    heapq.heappush(active, rank)
                if not len(at):
                    continue
        merge(at, merged)
    alive = symbols >= 0
    ids = symbols[alive].astype("<u4").tobytes()
    cuts = (4 * np.concatenate([[0], np.cumsum(np.add.reduceat(alive, starts, dtype=np.int64))])).tolist()
    return [ids[a:b] for a, b in zip(cuts, cuts[1:])]


def _lower(text: str) -> str:
    """Lower case character by character; a word-final sigma is not special."""
    return text.translate(_NEW_CAPITALS).replace("Σ", "σ").lower()


class PartitionEncoder:
    """Encodes the texts of one task; remembers the words it has met."""

    def __init__(self, path: str) -> None:
        self.vocab = vocabulary(path)
        self.known: dict[str, bytes] = {}
        self.known_chars = 0

    def words(self, text: str) -> list[str]:
        """Words of ``text``; a special token is a word of its own and stays as written."""
        if "<|" not in text:
            return self._plain(text)
        found, at = [], 0
        for match in self.vocab.split_special.finditer(text):
            found += self._plain(text[at:match.start()])
            found.append(match.group())
            at = match.end()
        return found + self._plain(text[at:])

    @staticmethod
    def _plain(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return _WORDS.findall(_lower(unicodedata.normalize("NFC", text)))
        return _LATIN_WORDS.findall(text.lower())

    def learn(self, words: Iterable[str]) -> None:
        if self.known_chars > KNOWN_CHARS:
            self.known.clear()
            self.known_chars = 0
        new = sorted({*words} - self.known.keys())
        # A text in lower case cannot hold a special token as a plain word: "<|" and "|>"
        # are cut from letters by the word pattern.
        special = [w for w in new if w in self.vocab.special]
        plain = [w for w in new if w not in self.vocab.special]
        self.known.update(zip(plain, merge_words([w.encode() for w in plain], self.vocab), strict=True))
        for word in special:
            self.known[word] = array("I", [self.vocab.special[word]]).tobytes()
        self.known_chars += sum(map(len, new))

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        waiting: list[list[str]] = []
        chars = 0
        for text in texts:
            waiting.append(self.words(text))
            chars += len(text)
            if chars >= SLICE_CHARS:
                yield from self._flush(waiting)
                waiting, chars = [], 0
        yield from self._flush(waiting)

    def _flush(self, waiting: list[list[str]]) -> Iterator[bytes]:
        self.learn(word for words in waiting for word in words)
        known = self.known
        for words in waiting:
            yield b"".join([known[w] for w in words])

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the tokens of ``ids``, with a space between two tokens."""
        tokens = self.vocab.tokens
        return b" ".join([tokens[i] for i in array("I", ids)])


def _texts(column: pa.Array) -> Iterator[str]:
    return (text or "" for text in (value.as_py() for value in column))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids``: the token ids of every whole text, as ``array<int>``.

    Null counts as empty, and an empty text has no ids. Every row of ``docs`` gives one row,
    repeated ids too; other columns are not looked at. ``path`` names the tokenizer file on
    every machine.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PartitionEncoder(path)
        for batch in batches:
            ids = [array("I", x).tolist() for x in encoder.encode(_texts(batch.column(1)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of the rows of :func:`encode_documents`; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PartitionEncoder(path)
        for batch in batches:
            texts = [encoder.decode(array("I", x.as_py() or []).tobytes()).decode()
                     for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document.

    Encodes and decodes as the two functions above, in one pass and without handing the
    ids back to the JVM.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PartitionEncoder(path)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for ids in encoder.encode(_texts(batch.column(1))):
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
                 pa.array(of_text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
