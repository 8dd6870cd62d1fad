"""CSV records of files whose quoted fields hold line breaks, without reading a file whole.

Where a record ends depends on whether the quotes before it are paired, back to the start
of the file. So the files are read once as plain lines, split over tasks like any text, and
stored as pieces of some megabytes together with what a piece does to that state: whether
its quotes come in pairs, and whether a record ends in it if it starts outside or inside
quotes. A running sum over these small facts gives each piece its state and tells which
piece the record began in that is open at its start. After that every piece is cut into
records by itself. Only the ends of records that cross a border between pieces are put
together by a group of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabproof.sources.shared import stored

#: Bytes of a piece, apart from lines that are longer.
PIECE_BYTES = 4 * 2**20

_QUOTE, _BREAK = ord('"'), ord("\n")
_PIECES = ("file string, block bigint, piece int, odd boolean, ends_outside boolean, ends_inside boolean, "
           "content binary")
_PARTS = "file string, record binary, chain bigint, place bigint, header boolean"


def _line_ends(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places of the line breaks, and whether the quotes before each are unpaired."""
    symbols = np.frombuffer(content, np.uint8)
    breaks = np.flatnonzero(symbols == _BREAK)
    quotes = np.flatnonzero(symbols == _QUOTE)
    return breaks, np.searchsorted(quotes, breaks) % 2 == 1


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.Array]]:
    """Lines of one file range each, in the order of the batch."""
    lines, files, blocks = batch.columns
    count = batch.num_rows
    changes = pc.or_(pc.not_equal(files[1:], files[:count - 1]), pc.not_equal(blocks[1:], blocks[:count - 1]))
    starts = [0, *(np.flatnonzero(changes.to_numpy(zero_copy_only=False)) + 1), count]
    for begin, end in zip(starts, starts[1:], strict=False):
        yield (files[begin].as_py(), blocks[begin].as_py()), lines[int(begin):int(end)]


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The stored pieces, numbered within the range of the file that a task reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, number, held, size = None, 0, [], 0

        def out() -> pa.RecordBatch:
            content = b"\n".join(held) + b"\n"
            _, inside = _line_ends(content)
            row = (*key, number, bool(content.count(b'"') % 2), bool((~inside).any()), bool(inside.any()), content)
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.bool_(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds, strict=True)],
                ["file", "block", "piece", "odd", "ends_outside", "ends_inside", "content"])

        for batch in batches:
            if not batch.num_rows:
                continue
            for new_key, lines in _runs(batch):
                if new_key != key:
                    if held:
                        yield out()
                    key, number, held, size = new_key, 0, [], 0
                for line in lines.to_pylist():
                    held.append(line)
                    size += len(line) + 1
                    if size >= PIECE_BYTES:
                        yield out()
                        number, held, size = number + 1, [], 0
        if held:
            yield out()

    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))
    return stored(lines.mapInArrow(run, _PIECES), "csv-pieces")


def _states(pieces: DataFrame) -> DataFrame:
    """Per piece whether it starts inside quotes, its place in the file, and the place of
    the piece in which the record began that is open at its start."""
    along = Window.partitionBy("file").orderBy("block", "piece")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    facts = pieces.select(
        "file", "block", "piece", "odd", "ends_inside", F.row_number().over(along).cast("bigint").alias("place"),
        (F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0)) % 2 == 1).alias("inside"))
    left_open = F.col("inside") != F.col("odd")
    begins = left_open & (~F.col("inside") | F.col("ends_inside"))
    return facts.withColumn("begins", F.when(begins, F.col("place"))).select(
        "file", "block", "piece", "place", "inside",
        F.last("begins", ignorenulls=True).over(before).alias("chain"))


def _cut(content: bytes, inside: bool) -> tuple[bytes | None, bytes, np.ndarray, bytes | None]:
    """What a piece holds: the end of the record open at its start, the bytes of its whole
    records and where each ends in them, and the start of the record open at its end."""
    breaks, unpaired = _line_ends(content)
    ends = breaks[unpaired == inside]
    if not len(ends):
        return (content[:-1], b"", ends, None) if inside else (None, b"", ends, content[:-1])
    head, start = (content[:ends[0]], ends[0] + 1) if inside else (None, 0)
    own = ends[1:] if inside else ends
    tail = content[ends[-1] + 1:-1] if ends[-1] != len(content) - 1 else None
    # The breaks between records go, those inside stay.
    kept = np.ones(len(content), bool)
    kept[own] = False
    kept[:start] = kept[ends[-1] + 1:] = False
    whole = np.frombuffer(content, np.uint8)[kept].tobytes()
    return head, whole, own - start - np.arange(len(own)), tail


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records, with no chain, and parts of records that cross borders."""
    for batch in batches:
        for file, content, inside, place, chain in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            head, whole, ends, tail = _cut(content, inside)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            records = pa.BinaryArray.from_buffers(
                pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(whole)])
            # The header is the first record with a character in it.
            filled = next((i for i, r in enumerate(records) if r.as_py().strip(b" \r")), None) if place == 1 else None
            header = np.zeros(len(ends), bool)
            if filled is not None:
                header[filled] = True
            ends_of = [(head, chain, False), (tail, place, place == 1 and filled is None)]
            ends_of = [e for e in ends_of if e[0] is not None]
            count = len(ends) + len(ends_of)
            yield pa.RecordBatch.from_arrays([
                pa.array([file] * count, pa.string()),
                pa.concat_arrays([records, pa.array([e[0] for e in ends_of], pa.binary())]),
                pa.array([None] * len(ends) + [e[1] for e in ends_of], pa.int64()),
                pa.array([place] * count, pa.int64()),
                pa.array([*header.tolist(), *(e[2] for e in ends_of)], pa.bool_()),
            ], ["file", "record", "chain", "place", "header"])


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, record, header``: the text of each record below ``path``, line breaks in
    quotes included; ``header`` marks the first one of a file.

    Records end at a line feed outside quotes, with or without a carriage return before
    it. Blank records are left out. Quotes are expected to be paired in every file.
    """
    pieces = _pieces(spark, path)
    states = _states(pieces)
    parts = (
        pieces.select("file", "block", "piece", "content").join(states, ["file", "block", "piece"])
        .select("file", "content", "inside", "place", "chain").mapInArrow(_parts, _PARTS))
    parts = parts.withColumn("record", F.col("record").cast("string"))
    whole = parts.where("chain IS NULL").select("file", "record", "header")
    crossing = parts.where("chain IS NOT NULL").groupBy("file", "chain").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("place", "record")))["record"], "\n").alias("record"),
        F.max("header").alias("header"))
    records = whole.unionByName(crossing.select("file", "record", "header"))
    returned = F.endswith("record", F.lit("\r"))
    record = F.when(returned, F.substring("record", 1, F.length("record") - 1)).otherwise(F.col("record"))
    return records.withColumn("record", record).where(F.trim("record") != "")
