"""Removal of long byte strings that occur before, across all documents.

Strings of 100 bytes are brought together by anchors: of the runs of 24 bytes inside a
string, the one with the least hash. Equal strings have equal anchors at the same place, so
all occurrences of a string meet under its anchor, and an anchor's surroundings, 76 bytes
on its left and 100 from its start, hold every string it is the anchor of. Per document
there are about two anchors in 78 bytes.

1. Each task finds the anchors of its texts and packs one record per distinct surroundings
   (two 64-bit hashes and a place) for each bucket of anchors; later copies inside the task
   are known to go and need no hash.
2. Per bucket, surroundings met before go as a whole. Where an anchor has more than one
   kind of surroundings, one place of each kind is asked for.
3. The places asked for are looked up in the texts, and the bytes travel to their anchor.
4. Per anchor, a suffix array by linear grouping orders the bytes right of the anchors and,
   reversed, those left of them. Neighbours in these orders tell which strings of which
   surroundings are equal; all but the earliest of equal strings go.
5. The spans of each document are joined to it and cut out.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabproof.llm.spool import spool
from tabproof.llm.suffix_array import sorted_rows

LENGTH = 100
GRAM = 24
LEFT = LENGTH - GRAM
#: Bytes of text hashed together, anchors packed together and surroundings ordered
#: together. They bound memory; an anchor's surroundings stay together in any case.
SLICE_BYTES = 2_000_000
PACK_ANCHORS = 2_000_000
ORDER_ROWS = 20_000
#: Buckets of anchors per shuffle partition.
BUCKETS = 4

_U = np.uint64
_MANY = np.random.default_rng(7).integers(1, 2**63, 32, np.uint64) * _U(2) + _U(1)
_PAD = bytes(LENGTH + 8)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


def _words(buffer: bytes) -> np.ndarray:
    """The eight bytes from each place on, as a number."""
    return np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,))


def find_anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all strings of ``LENGTH`` bytes in ``texts``.

    Returns per anchor its text, its place there, the hash of its run and the hash of its
    surroundings, which are shorter at the ends of a text.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    buffer = _PAD + b"".join(t + _PAD for t in texts)
    starts = len(_PAD) + np.cumsum(sizes + len(_PAD)) - sizes - len(_PAD)
    words = _words(buffer)
    grams = len(words) - 16
    runs = words[:grams] * _MANY[0] + (words[8:grams + 8] ^ _MANY[3]) * _MANY[1]
    runs += (words[16:grams + 16] ^ _MANY[4]) * _MANY[2]
    runs = _mix(runs)
    # High half: hash, low half: place. So the least of equal hashes is the leftmost.
    keys = runs & _U(0xFFFFFFFF00000000) | np.arange(grams, dtype=np.uint64)
    span = LEFT + 1
    padded = np.full(-(-grams // span) * span + span, ~_U(0), np.uint64)
    padded[:grams] = keys
    blocks = padded.reshape(-1, span)
    heads = np.minimum.accumulate(blocks, 1).reshape(-1)
    tails = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].reshape(-1)
    # Strings lie inside one text.
    inside = np.zeros(len(buffer) + 1, np.int8)
    long = sizes >= LENGTH
    inside[starts[long]] += 1
    inside[starts[long] + sizes[long] - LENGTH + 1] -= 1
    first = np.flatnonzero(np.cumsum(inside, dtype=np.int8))
    place = (np.minimum(tails[first], heads[first + span - 1]) & _U(0xFFFFFFFF)).astype(np.int64)
    place = place[np.concatenate([[True], place[1:] != place[:-1]])] if len(place) else place
    text = np.searchsorted(starts, place, "right") - 1
    offset = place - starts[text]
    around = words[(place - LEFT)[:, None] + 8 * np.arange((LEFT + LENGTH) // 8)]
    around = _mix((around ^ _MANY[5:5 + around.shape[1]]) * _MANY[6:6 + around.shape[1]]).sum(1, dtype=np.uint64)
    clips = np.minimum(offset, LEFT) * 1024 + np.minimum(sizes[text] - offset, LENGTH)
    return text, offset, runs[place], _mix(around + clips.astype(np.uint64) * _MANY[31])


class Pack:
    """Anchors of one task on their way to buckets."""

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self.clear()

    def clear(self) -> None:
        self.docs: list[tuple[int, int, int]] = []
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, docs: list[tuple[int, int, int]], texts: list[bytes]) -> None:
        text, offset, run, around = find_anchors(texts)
        self.parts.append((text + len(self.docs), offset, run, around))
        self.docs += docs
        self.size += len(text)

    def flush(self) -> Iterator[tuple[int, bytes]]:
        """``bucket, bytes``: a record of each kind of surroundings, and later copies."""
        if self.size:
            text, offset, run, around = (np.concatenate(x) for x in zip(*self.parts, strict=True))
            table = np.array(self.docs, np.int64).reshape(-1, 3)
            by_rank = np.lexsort((offset, table[text, 1], table[text, 0], around, run))
            text, offset, run, around = text[by_rank], offset[by_rank], run[by_rank], around[by_rank]
            fresh = ~_same_place(table[text], offset, run, around)
            text, offset, run, around = text[fresh], offset[fresh], run[fresh], around[fresh]
            later = np.zeros(len(text), bool)
            later[1:] = (run[1:] == run[:-1]) & (around[1:] == around[:-1])
            bucket = (run % _U(self.buckets)).astype(np.int64)
            # Copies are done with, so they are dealt evenly by document instead.
            bucket[later] = (table[text[later], 0] + offset[later] // 4096) % self.buckets
            order = np.lexsort((later, bucket))
            edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
            for b in range(self.buckets):
                rows = order[edges[b]:edges[b + 1]]
                if len(rows):
                    yield b, _packed(table, text[rows], offset[rows], run[rows], around[rows], later[rows])
        self.clear()


def _same_place(docs, offset, run, around) -> np.ndarray:
    """Sorted records that name the place of the one before: rows repeating id and text."""
    same = np.zeros(len(run), bool)
    same[1:] = ((run[1:] == run[:-1]) & (around[1:] == around[:-1]) & (offset[1:] == offset[:-1])
                & (docs[1:] == docs[:-1]).all(1))
    return same


def _packed(table, text, offset, run, around, later) -> bytes:
    used, local = np.unique(text, return_inverse=True)
    kept = int((~later).sum())
    head = np.array([len(used), len(text), kept], "<i8")
    return b"".join(x.tobytes() for x in (
        head, table[used].astype("<i8").T.copy(), local.astype("<u4"), offset.astype("<u4"),
        run[:kept].astype("<u8"), around[:kept].astype("<u8")))


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document (id, mark, size) and place of all records; hashes of the first ones."""
    docs, rows, kept = np.frombuffer(data, "<i8", 3)
    at = 24
    table = np.frombuffer(data, "<i8", docs * 3, at).reshape(3, docs)
    at += 24 * docs
    local, at = np.frombuffer(data, "<u4", rows, at), at + 4 * rows
    offset, at = np.frombuffer(data, "<u4", rows, at).astype(np.int64), at + 4 * rows
    run, at = np.frombuffer(data, "<u8", kept, at), at + 8 * kept
    return table.T[local], offset, run, np.frombuffer(data, "<u8", kept, at)


_FOUND = "doc bigint, mark bigint, span bigint, anchor bigint"


def _found_batch(docs: np.ndarray, span: np.ndarray, anchor: np.ndarray | None) -> pa.RecordBatch:
    """Rows of a place asked for (``anchor`` set) or of a span that goes (``anchor`` null)."""
    empty = pa.nulls(len(span), pa.int64()) if anchor is None else pa.array(anchor.view(np.int64))
    return pa.RecordBatch.from_arrays(
        [pa.array(docs[:, 0]), pa.array(docs[:, 1]), pa.array(span), empty],
        ["doc", "mark", "span", "anchor"])


def _whole(docs: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """The surroundings at these places as spans: begin and end in one number."""
    begin = offset - np.minimum(offset, LEFT)
    return begin << 32 | np.minimum(offset + LENGTH, docs[:, 2])


def _resolve(packs: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Spans that go and places asked for of one bucket."""
    firsts, later = [], []
    for data in packs:
        docs, offset, run, around = _unpacked(data)
        kept = len(run)
        firsts.append((docs[:kept], offset[:kept], run, around))
        later.append((docs[kept:], offset[kept:]))
    docs, offset, run, around = (np.concatenate(x) for x in zip(*firsts, strict=True))
    order = np.lexsort((offset, docs[:, 1], docs[:, 0], around, run))
    docs, offset, run, around = docs[order], offset[order], run[order], around[order]
    fresh = ~_same_place(docs, offset, run, around)
    docs, offset, run, around = docs[fresh], offset[fresh], run[fresh], around[fresh]
    same_run = np.zeros(len(run) + 1, bool)
    same_run[1:-1] = run[1:] == run[:-1]
    copy = np.zeros(len(run), bool)
    copy[1:] = same_run[1:-1] & (around[1:] == around[:-1])
    gone_docs = np.concatenate([docs[copy], *(d for d, _ in later)])
    gone_at = np.concatenate([offset[copy], *(o for _, o in later)])
    yield _found_batch(gone_docs, _whole(gone_docs, gone_at), None)
    docs, offset, run = docs[~copy], offset[~copy], run[~copy]
    shared = np.zeros(len(run), bool)
    alike = run[1:] == run[:-1]
    shared[1:] |= alike
    shared[:-1] |= alike
    yield _found_batch(docs[shared], offset[shared], run[shared])


def _doc_key() -> list[Column]:
    """A document: its id (null is the largest), and a mark that tells texts of one id apart."""
    return [F.coalesce(F.col("doc_id").cast("bigint"), F.lit(2**63 - 1)).alias("doc"),
            F.crc32(F.encode("text", "UTF-8")).alias("mark")]


def _anchors(docs: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = Pack(buckets)

        def out() -> Iterator[pa.RecordBatch]:
            for bucket, data in pack.flush():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int32()), pa.array([data], pa.binary())], ["bucket", "pack"])

        for batch in batches:
            waiting, texts, size = [], [], 0
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = value.as_py().encode()
                if len(text) < LENGTH:
                    continue
                waiting.append((doc, zlib.crc32(text), len(text)))
                texts.append(text)
                size += len(text)
                if size >= SLICE_BYTES:
                    pack.add(waiting, texts)
                    waiting, texts, size = [], [], 0
            if texts:
                pack.add(waiting, texts)
            if pack.size >= PACK_ANCHORS:
                yield from out()
        yield from out()

    return docs.select("doc", "text").mapInArrow(run, "bucket int, pack binary")


def _resolved(packs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting = None, []
        for batch in batches:
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if bucket != now and waiting:
                    yield from _resolve(waiting)
                    waiting = []
                now = bucket
                waiting.append(data.as_py())
        if waiting:
            yield from _resolve(waiting)

    return packs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, _FOUND)


def _surroundings(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """The bytes around each place asked for, padded where the text ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for doc, mark, value, places, anchors in zip(*(batch.column(c) for c in (
                    "doc", "mark", "text", "places", "anchors")), strict=True):
                text = value.as_py().encode()
                # Rows repeating id and text mostly come in a row here; once is enough.
                if (doc, mark, text) == before:
                    continue
                before = doc, mark, text
                padded = bytes(LEFT) + text + bytes(LENGTH)
                for at, anchor in zip(places.as_py(), anchors.as_py(), strict=True):
                    for out, item in zip(rows, (anchor, doc.as_py(), mark.as_py(), at, len(text),
                                                padded[at:at + LEFT + LENGTH]), strict=True):
                        out.append(item)
            kinds = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, rows, kinds)], ["anchor", "doc", "mark", "at", "size", "around"])

    lists = asked.groupBy("doc", "mark").agg(
        F.collect_list("span").alias("places"), F.collect_list("anchor").alias("anchors"))
    # The same columns as in the last join, and no filter on them: Spark then deals the
    # texts out by document once for both.
    joined = lists.join(texts, ["doc", "mark"], "left").select(
        "doc_id", "doc", "mark", "text", "places", "anchors")
    return joined.mapInArrow(
        run, "anchor bigint, doc bigint, mark bigint, at bigint, size bigint, around binary")


def _equal_prefix(rows: np.ndarray) -> np.ndarray:
    """Bytes that each row shares with the one before it; 0 for the first."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        out[1:] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return out


def _may_share(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Rows that may share a string with another row of their anchor.

    Strings that begin ``q`` to ``q + 10`` bytes left of the anchor all hold the 90 bytes
    from ``q`` left of it on. Rows alone in all of these parts share none.
    """
    powers = np.cumprod(np.full(LEFT + LENGTH, _MANY[9], np.uint64))
    sums = np.zeros((len(rows), LEFT + LENGTH + 1), np.uint64)
    np.cumsum(rows * powers, axis=1, out=sums[:, 1:], dtype=np.uint64)
    keep = np.zeros(len(rows), bool)
    for q in range(0, LEFT + 1, 11):
        part = sums[:, LEFT - q + 90] - sums[:, LEFT - q]
        order = np.lexsort((part, anchor))
        alike = (part[order][1:] == part[order][:-1]) & (anchor[order][1:] == anchor[order][:-1])
        keep[order[1:][alike]] = True
        keep[order[:-1][alike]] = True
    return keep


def equal_strings(rows: np.ndarray, docs: np.ndarray, at: np.ndarray, size: np.ndarray):
    """First and last string, as bytes left of the anchor, that is not the earliest of its
    kind in each row (``-1`` if none). Rows are surroundings; their anchors differ or not.
    """
    right = np.zeros((len(rows), LENGTH + 4), np.uint8)
    right[:, :LENGTH] = rows[:, LEFT:]
    left = np.zeros((len(rows), LEFT + 4), np.uint8)
    left[:, :LEFT] = rows[:, :LEFT][:, ::-1]
    by_right, by_left = sorted_rows(right), sorted_rows(left)
    right_equal, left_equal = _equal_prefix(right[by_right]), _equal_prefix(left[by_left])
    rank = np.empty(len(rows), np.int64)
    rank[np.lexsort((at, docs[:, 1], docs[:, 0]))] = np.arange(len(rows))
    room_left, room_right = np.minimum(at, LEFT), np.minimum(size - at, LENGTH)
    least, most = np.full(len(rows), -1), np.full(len(rows), -1)
    kind = np.empty((2, len(rows)), np.int64)
    for j in range(LEFT + 1):
        kind[0, by_right] = np.cumsum(right_equal < LENGTH - j)
        kind[1, by_left] = np.cumsum(left_equal < j)
        fits = np.flatnonzero((room_left >= j) & (room_right >= LENGTH - j))
        # Only kinds that occur twice on the right can hold equal strings.
        fits = fits[np.bincount(kind[0, fits], minlength=1)[kind[0, fits]] > 1] if len(fits) else fits
        if not len(fits):
            continue
        order = fits[np.lexsort((rank[fits], kind[1, fits], kind[0, fits]))]
        again = order[1:][(kind[:, order[1:]] == kind[:, order[:-1]]).all(0)]
        most[again] = j
        least[again] = np.where(least[again] < 0, j, least[again])
    return least, most


def _compared(around: DataFrame) -> DataFrame:
    """Spans that go because strings in different surroundings are equal."""

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        anchor = np.array([r[0] for r in rows], np.int64)
        docs = np.array([r[1:3] for r in rows], np.int64)
        at, size = (np.array([r[k] for r in rows], np.int64) for k in (3, 4))
        data = np.frombuffer(b"".join(r[5] for r in rows), np.uint8).reshape(-1, LEFT + LENGTH)
        # Rows repeating id and text are one place.
        places = np.column_stack([anchor, docs, at, size])
        once = np.unique(places, axis=0, return_index=True)[1]
        anchor, docs, at, size, data = anchor[once], docs[once], at[once], size[once], data[once]
        keep = _may_share(data, anchor)
        anchor, docs, at, size, data = anchor[keep], docs[keep], at[keep], size[keep], data[keep]
        if not len(anchor):
            return _found_batch(docs, at, None)
        least, most = equal_strings(data, docs, at, size)
        gone = most >= 0
        begin, stop = at[gone] - most[gone], at[gone] - least[gone] + LENGTH
        # Two strings of one row overlap, so all between the first and the last goes.
        return _found_batch(docs[gone], begin << 32 | stop, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                if len(rows) >= ORDER_ROWS and row[0] != rows[-1][0]:
                    yield settle(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield settle(rows)

    return around.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, _FOUND)


def cut(text: bytes, spans: list[int]) -> tuple[bytes, list[tuple[int, int]]]:
    """``text`` without the union of the spans, and the maximal runs taken out."""
    runs: list[list[int]] = []
    for span in sorted(spans):
        begin, stop = span >> 32, span & 0xFFFFFFFF
        if runs and begin <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], stop)
        else:
            runs.append([begin, stop])
    kept, at = [], 0
    for begin, stop in runs:
        kept.append(text[at:begin])
        at = stop
    return b"".join([*kept, text[at:]]), [(a, b) for a, b in runs]


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text, spans``: every document with the spans of bytes that occur before.

    ``spans`` holds ``begin * 2^32 + end`` of strings of 100 bytes, or unions of such, that
    also start earlier: in a document of smaller id, or further left. Strings are judged on
    the input. Null counts as empty; matches stay inside documents. A null id comes last.
    Documents of one id are ordered by a checksum of their texts, and rows equal in id and
    text are one document, each with the same result. An empty table gives no rows; other
    columns are not looked at.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.select("doc_id", *_doc_key(), "text")
    buckets = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = spool(_resolved(_anchors(texts, buckets)), "repeats-found")
    asked = found.where("anchor IS NOT NULL")
    gone = found.where("anchor IS NULL").select("doc", "mark", "span")
    around = _surroundings(texts, asked)
    more = _compared(around).select("doc", "mark", "span")
    spans = gone.unionByName(more).groupBy("doc", "mark").agg(F.collect_list("span").alias("spans"))
    return texts.join(spans, ["doc", "mark"], "left").select("doc_id", "text", "spans")


def _per_document(docs: DataFrame, make, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield make(batch)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return repeated_spans(docs).mapInArrow(run, f"doc_id {kind}, {schema}")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: the documents without bytes that occur before. A character cut in
    two is replaced."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [cut(t.as_py().encode(), s.as_py() or [])[0].decode("utf-8", "replace")
                 for t, s in zip(batch.column("text"), batch.column("spans"), strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return _per_document(docs, make, "text string")


def repeat_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], []]
        for value, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
            text = value.as_py().encode()
            kept, runs = cut(text, spans.as_py() or [])
            for out, item in zip(columns, (len(text), len(text) - len(kept), len(runs),
                                           hashlib.sha256(kept).hexdigest()), strict=True):
                out.append(item)
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *map(pa.array, columns, kinds)],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _per_document(docs, make, "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
