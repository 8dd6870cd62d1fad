"""Benchmark decontamination by word windows, in DataFrame expressions only.

The benchmark's windows of ten words become a bit set of fixed size, which every task
holds. A document's windows are looked up in it by position; only windows whose bit is set
leave the row, with their words. A hash join on these words with the benchmark's windows
then decides: a shared bit removes nothing. So a text is scanned once and never shuffled,
and what travels is in proportion to the passages shared with the benchmark.

The bit set grows with the benchmark up to ``MOST_BITS``; past that more windows come to
the join, and the result is the same. The windows are broadcast to the join if their
measured size is below ``BROADCAST_BYTES`` and shuffled otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabproof.llm.spool import spool

#: Words of a window, and what separates words once A-Z are lower case.
WINDOW = 10
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same for texts in their own case.
ANY_CASE_BREAK = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bits of the set: at least, at most, and for each window of the benchmark.
LEAST_BITS, MOST_BITS, BITS_EACH = 2**20, 2**26, 32
#: Bytes of window text that are broadcast.
BROADCAST_BYTES = 32 * 2**20
#: Numbers of 64 bits that one row holds while the bit set is put together.
CHUNK = 1024


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of ``text``, A-Z in lower case; null has none.

    ``lower`` is many times faster than ``translate`` and gives the same unless there are
    capitals beyond A-Z.
    """
    text = F.coalesce(text, F.lit(""))
    small = F.when(text.rlike(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]"), F.translate(text, UPPER, UPPER.lower())
                   ).otherwise(F.lower(text))
    # Only the first and the last part can be empty.
    return F.filter(F.split(small, BREAKS), lambda w: w != "")


def _key(hashes: Column, at: Column, n: int) -> Column:
    """Hash of a window by three of its words: the same windows have the same."""
    return F.xxhash64(F.lit(n), F.get(hashes, at), F.get(hashes, at + (n - 1) // 2), F.get(hashes, at + (n - 1)))


def _keys(hashes: Column, n: int) -> Column:
    return F.transform(_starts(hashes, n), lambda i: _key(hashes, i, n))


def _gram(found: Column, at: Column, n: int) -> Column:
    return F.array_join(F.slice(found, at + 1, n), " ")


def _starts(found: Column, n: int) -> Column:
    """Places of all windows of ``n`` words, from 0."""
    last = F.size(found) - n
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _hashes(found: Column) -> Column:
    return F.transform(found, lambda w: F.xxhash64(w))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``item, n, key, gram`` for every window of every item, repeats once.

    An item of fewer than ten words, but not none, is one window. A null ``item_id`` counts
    as an empty one.
    """
    own = words(F.col("text"))

    def of(n: int, found: Column) -> Column:
        return F.transform(_starts(found, n), lambda i: F.struct(
            F.lit(n).alias("n"), _key(_hashes(F.slice(found, i + 1, n)), F.lit(0), n).alias("key"),
            _gram(found, i, n).alias("gram")))

    windows = let(own, lambda found: F.coalesce(
        *[F.when(F.size(found) == n, of(n, found)) for n in range(1, WINDOW)], of(WINDOW, found)))
    return benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.explode_outer(windows).alias("w"),
    ).select("item", "w.*").where("gram IS NOT NULL").distinct()


def _bit_set(keys: DataFrame, bits: int) -> Column:
    """An array of arrays of 64-bit numbers with the bit of each key set, as one value that
    is computed once and travels with the tasks."""
    place = F.pmod("key", F.lit(bits))
    used = keys.select(F.floor(place / 64).cast("bigint").alias("slot"),
                       F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int")).alias("bit"))
    used = used.groupBy("slot").agg(F.bit_or("bit").alias("bits"))
    slots = keys.sparkSession.range(bits // 64).withColumnRenamed("id", "slot")
    chunks = slots.join(used, "slot", "left").groupBy(F.floor(F.col("slot") / CHUNK).alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct("slot", F.coalesce("bits", F.lit(0)).alias("bits")))).alias("of"))
    chunks = chunks.select(F.struct("chunk", F.col("of.bits").alias("of")).alias("c"))
    return chunks.agg(F.array_sort(F.collect_list("c"))["of"].alias("set")).scalar()


def _is_set(bit_set: Column, key: Column, bits: int) -> Column:
    place = key.bitwiseAND(F.lit(bits - 1))
    slot = F.shiftright(place, 6)
    chunk, inside = F.floor(slot / CHUNK).cast("int"), slot.bitwiseAND(F.lit(CHUNK - 1)).cast("int")
    number = F.get(F.get(bit_set, chunk), inside)
    shift = place.bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftrightunsigned", number, shift).bitwiseAND(F.lit(1)) == 1


def _scanned(docs: DataFrame, bit_set: Column, bits: int, lengths: list[int]) -> DataFrame:
    """A row per document with ``n_words`` and one per window whose bit is set.

    The keys of a document's windows are one array, which is taken apart in the same
    generated code that tests the bits, so the words are copied for the windows that pass
    and not for each place.
    """
    found, hashes = F.col("words"), F.transform("words", lambda w: F.xxhash64(w))
    keys = let(hashes, lambda h: F.concat(
        F.array(F.lit(None).cast("bigint")), *[_keys(h, n) for n in lengths]))
    rows = docs.select(
        "doc_id", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("mark"),
        words(F.col("text")).alias("words"),
    ).withColumn("keys", keys)
    # ``keys`` is never empty; without "outer" Spark would filter by its size, which it
    # would work out from the text a second time.
    rows = rows.select("doc_id", "mark", "words", F.posexplode_outer("keys").alias("place", "key"))
    rows = rows.where((F.col("place") == 0) | _is_set(bit_set, F.col("key"), bits))
    # The place among all keys says which length a window has and where it starts.
    at, n, before = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(1)
    for length in lengths:
        until = before + F.greatest(F.size(found) - (length - 1), F.lit(0))
        mine = (F.col("place") >= before) & (F.col("place") < until)
        at = F.when(mine, F.col("place") - before).otherwise(at)
        n = F.when(mine, F.lit(length)).otherwise(n)
        before = until
    return rows.select(
        "doc_id", "mark", F.when(F.col("place") == 0, F.size(found)).cast("bigint").alias("n_words"),
        at.alias("at"), n.alias("n"),
        F.when(F.col("place") > 0, F.array_join(F.slice(found, at + 1, n), " ")).alias("gram"))


def _verified(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (``doc_id, mark, n_words``), windows found in them (``doc_id, mark, at, n,
    gram``) and the benchmark's windows (``item, gram``)."""
    windows = spool(benchmark_windows(benchmark), "leak-windows")
    grams = windows.select("gram", "n", "key").distinct()
    size = grams.agg(F.count(F.lit(1)), F.sum(F.octet_length("gram")), F.collect_set("n")).first()
    bits = LEAST_BITS
    while bits < MOST_BITS and bits < BITS_EACH * size[0]:
        bits *= 2
    rows = spool(_scanned(docs, _bit_set(grams, bits), bits, sorted(size[2])), "leak-rows")
    grams = grams.select("gram")
    if (size[1] or 0) <= BROADCAST_BYTES:
        grams = F.broadcast(grams)
    found = rows.where("at IS NOT NULL").join(grams, "gram", "left_semi")
    return rows.where("at IS NULL").select("doc_id", "mark", "n_words"), found, windows


def _spans(found: DataFrame) -> DataFrame:
    """``of_id, of_mark, spans``: the places of the windows in each document, in order."""
    return found.groupBy(F.col("doc_id").alias("of_id"), F.col("mark").alias("of_mark")).agg(
        F.array_sort(F.collect_set(F.struct("at", "n"))).alias("spans"))


def _hit_words(spans: Column) -> Column:
    """Number of words in the union of ``spans``, which are in order of their start."""
    return F.aggregate(
        spans, F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("hit")),
        lambda so, s: F.struct(
            F.greatest(so["end"], s["at"] + s["n"]).alias("end"),
            (so["hit"] + F.greatest(s["at"] + s["n"] - F.greatest(so["end"], s["at"]), F.lit(0))).alias("hit")),
        lambda so: so["hit"])


def _same(left: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(F.col("of_id")) & (left["mark"] == F.col("of_mark"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: how much of it stands in ``benchmark``.

    Returns ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``. A word is hit
    if it lies in an occurrence of a window of any item; ``n_items`` counts the items with
    a window that occurs. Null and empty texts have no words and are not contaminated; the
    same goes for items. Items that share an id are one item, and a null id is an empty
    one. Rows that repeat id and text are judged alike, each in its own row; texts that
    share an id, or have none, are told apart by a digest. Empty tables give no rows or no
    hits; other columns are not looked at.
    """
    heads, found, windows = _verified(docs, benchmark)
    spans = _spans(found).select("of_id", "of_mark", _hit_words(F.col("spans")).alias("n_hit"))
    items = (
        found.select("doc_id", "mark", "gram").distinct().join(windows.select("item", "gram"), "gram")
        .groupBy(F.col("doc_id").alias("of_id"), F.col("mark").alias("of_mark"))
        .agg(F.array_sort(F.collect_set("item")).alias("items")))
    items = items.select(F.col("of_id").alias("_id"), F.col("of_mark").alias("_mark"), "items")
    verdicts = spans.join(items, spans["of_id"].eqNullSafe(items["_id"]) & (spans["of_mark"] == items["_mark"]))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return heads.join(verdicts, _same(heads), "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any hit word, all columns."""
    _, found, _ = _verified(docs, benchmark)
    return _beside(docs, _spans(found), "left_anti").drop("doc_mark")


def cut_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with the hit words cut from ``text``, each with what follows it up to the
    next word. Other texts and columns stay as they are."""
    _, found, _ = _verified(docs, benchmark)
    text = F.col("text")
    lead = F.regexp_extract(text, rf"^[{ANY_CASE_BREAK}]*", 0)
    parts = F.regexp_extract_all(text, F.lit(rf"[^{ANY_CASE_BREAK}]+[{ANY_CASE_BREAK}]*"), F.lit(0))
    hit = F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["n"] - 1)))
    left = let(parts, lambda p: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(p) - 1), hit), lambda i: F.get(p, i)), ""))
    joined = _beside(docs, _spans(found), "left")
    cut = F.when(F.col("spans").isNotNull(), F.concat(lead, left)).otherwise(text)
    return joined.select(*[(cut if c == "text" else F.col(f"`{c}`")).alias(c) for c in docs.columns])


def _beside(docs: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    marked = docs.withColumn("doc_mark", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    spans = spans.select(*[F.col(c).alias(c if c == "spans" else f"leak_{c}") for c in spans.columns])
    return marked.join(spans, marked["doc_id"].eqNullSafe(spans["leak_of_id"])
                       & (marked["doc_mark"] == spans["leak_of_mark"]), how)
