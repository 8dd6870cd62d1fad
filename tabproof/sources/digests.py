"""Digests of files of any size.

The SHA-256 of a file is sequential by definition, so one task reads a file from its start
to its end, in pieces of fixed size. The block digest is made for files too large for that:
every block has its own SHA-256, blocks of one file are read by many tasks, and the digests
of up to ``FANOUT`` neighbours are joined and hashed again until one is left.

Files below ``WHOLE_BYTES`` are read by Spark's binary reader. Larger ones are read by
range through the file system that their address names. Spark lists no empty files, so they
have no row and count in no folder.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files up to this size are one binary value in a row.
WHOLE_BYTES = 256 * 2**20
#: Bytes of a block, digests that are joined, and bytes read at a time.
BLOCK_BYTES = 8 * 2**20
FANOUT = 1024
READ_BYTES = 2**20


def _range_digest(path: str, start: int, size: int) -> str:
    """SHA-256 of ``size`` bytes of a file, held a piece at a time."""
    scheme, host, name = re.fullmatch(r"(\w+):(?://([^/]*))?(/.*)", path, re.DOTALL).groups()
    scheme = re.sub("^s3[an]$", "s3", scheme)
    system, name = fs.FileSystem.from_uri(f"{scheme}://{host or ''}{quote(name)}")
    digest = hashlib.sha256()
    with system.open_input_file(name) as file:
        file.seek(start)
        while size:
            piece = file.read(min(size, READ_BYTES))
            if not piece:
                raise OSError(f"{path} is shorter than its listing says")
            digest.update(piece)
            size -= len(piece)
    return digest.hexdigest()


def _digest_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            found = _range_digest(row["path"], row["start"], row["size"])
            yield pa.RecordBatch.from_pylist([row | {"digest": found}])


def _listed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path)


def file_manifest(spark: SparkSession, path: str, digest: bool = True) -> DataFrame:
    """``path, length, sha256`` of every file below ``path``; without ``digest`` the first
    two, from the listing alone."""
    files = _listed(spark, path)
    if not digest:
        return files.select("path", "length")
    small = files.where(F.col("length") <= WHOLE_BYTES).select(
        "path", "length", F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > WHOLE_BYTES).select(
        "path", F.lit(0).cast("bigint").alias("start"), F.col("length").alias("size"))
    large = large.mapInArrow(_digest_ranges, "path string, start bigint, size bigint, digest string")
    return small.unionByName(large.select("path", F.col("size").alias("length"), F.col("digest").alias("sha256")))


def _blocks(length: Column, block: int) -> Column:
    """Numbers of a file's blocks."""
    return F.sequence(F.lit(0).cast("bigint"), F.ceil(length / block) - 1)


def block_digests(spark: SparkSession, path: str, block: int = BLOCK_BYTES) -> DataFrame:
    """``path, length, place, digest``: the SHA-256 of every block of every file."""
    files = _listed(spark, path)

    def of_blocks(content: Column) -> Column:
        return F.transform(_blocks(F.col("length"), block), lambda i: F.struct(
            i.alias("place"), F.sha2(F.substring(content, (i * block + 1).cast("int"), F.lit(block)), 256).alias("digest")))

    # A column of a row is copied whole wherever it is read, which would be once a block. The
    # outer lambda takes the content out of its row once, and the blocks are cut from that.
    of_block = F.flatten(F.transform(F.array("content"), of_blocks))
    small = files.where(F.col("length") <= WHOLE_BYTES).select("path", "length", F.inline(of_block))
    large = files.where(F.col("length") > WHOLE_BYTES).select(
        "path", "length", F.explode(_blocks(F.col("length"), block)).alias("place"))
    # The listing is a few rows; the reading is dealt out by block.
    large = large.repartition("path", "place").select(
        "path", "length", "place", (F.col("place") * block).alias("start"),
        F.least(F.lit(block), F.col("length") - F.col("place") * block).alias("size"))
    large = large.mapInArrow(
        _digest_ranges, "path string, length bigint, place bigint, start bigint, size bigint, digest string")
    return small.unionByName(large.select("path", "length", "place", "digest"))


def file_digests(spark: SparkSession, path: str, block: int = BLOCK_BYTES, fanout: int = FANOUT) -> DataFrame:
    """``path, length, digest``: the block digest of every file below ``path``.

    A file of one block has that block's SHA-256. Otherwise the digests of ``fanout``
    neighbours, as hexadecimal text in the order of the file, are joined and hashed, level
    by level. A file's digest depends on its bytes, ``block`` and ``fanout`` alone.
    """
    if block < 1 or fanout < 2:
        raise ValueError("block must be positive and fanout at least 2")
    longest = file_manifest(spark, path, digest=False).agg(F.max("length")).first()[0] or 0
    nodes = block_digests(spark, path, block).withColumn("nodes", F.ceil(F.col("length") / block))
    most = -(-longest // block)
    while most > 1:
        joined = F.array_join(F.array_sort(F.collect_list(F.struct("place", "digest")))["digest"], "")
        above = nodes.groupBy("path", "length", "nodes", F.floor(F.col("place") / fanout).alias("above")).agg(
            F.when(F.col("nodes") == 1, F.first("digest")).otherwise(F.sha2(joined, 256)).alias("digest"))
        nodes = above.select("path", "length", F.col("above").alias("place"), "digest",
                             F.ceil(F.col("nodes") / fanout).alias("nodes"))
        most = -(-most // fanout)
    return nodes.select("path", "length", "digest")


def folder_digest(spark: SparkSession, path: str, block: int = BLOCK_BYTES, fanout: int = FANOUT) -> str:
    """One digest of all files below ``path``, whatever their number, names and order.

    The files' digests are grouped by their first three digits; each group's, in order,
    are joined by line breaks and hashed, and so are the 4096 groups' at most. No files
    give the digest of nothing.
    """
    files = file_digests(spark, path, block, fanout)
    groups = files.groupBy(F.substring("digest", 1, 3).alias("start")).agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list("digest")), "\n"), 256).alias("digest"))
    return groups.agg(F.sha2(F.array_join(
        F.array_sort(F.collect_list(F.struct("start", "digest")))["digest"], "\n"), 256)).first()[0]
