"""Secret scans that look through nested encodings.

A worklist starts with the whole text. Every layer taken from it is searched, then
unwrapped: percent escapes, Unicode escapes and character references give a new layer of
the same length or less, runs of base64 give layers of bytes, a character each. Bytes that
hold characters of two bytes give a layer of those, and gzip, zlib, deflate, bzip2 or xz
data is expanded. Layers go on the list until none is new. Each layer can tell where its characters come from in the
one below, so that a finding is reported by its place in the original.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import html
import lzma
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in their order, patterns, and the shortest match that counts.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_ASSIGN_CHARS, _ACCESS_CHARS = 8, 16

_PERCENT = re.compile(r"%[0-9A-Fa-f]{2}(?:%[0-9A-Fa-f]{2})*")
_ESCAPES = re.compile(
    r"\\(?:u[0-9A-Fa-f]{4}(?:\\u[0-9A-Fa-f]{4})*|u\{[0-9A-Fa-f]{1,6}\}|U[0-9A-Fa-f]{8}"
    r"|x[0-9A-Fa-f]{2}(?:\\x[0-9A-Fa-f]{2})*)")
_REFERENCES = re.compile(r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Base64 wrapped over lines; line breaks may be written as escapes. A run is tried from
#: its first letter only and never given back, so the search is linear.
_WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{4,}+"
    r"(?:[ \t]*+(?:\r?\n|\r|(?:\\r)?\\n)[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}")
_BREAK = re.compile(r"[ \t]*+(?:\r?\n|\r|(?:\\r)?\\n)[ \t]*+")
#: The two bytes that can begin zlib data: deflate, any window, a sound check, no dictionary.
_ZLIB = b"|".join(
    re.escape(bytes((method,))) + b"[" + b"".join(
        b"\\x%02x" % flags for flags in range(256) if (method * 256 + flags) % 31 == 0 and not flags & 0x20) + b"]"
    for method in range(0x08, 0x80, 0x10))
#: Where bytes may be compressed.
_MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\x00|(?:" + _ZLIB + rb")")
#: Bytes with characters of two bytes each, one of them zero.
_WIDE = re.compile(rb"(?:[\x09-\x7e]\x00){8}|(?:\x00[\x09-\x7e]){8}")
#: Bytes that can hold something that is looked for, compressed data apart.
_WORTH = re.compile(
    rb"(?i:passw|secret|token|api_?key)|AKIA|[0-9a-f]{32}|%[0-9A-Fa-f]{2}|\\[uUx]|&[#A-Za-z]|[A-Za-z0-9+/_-]{16}"
    rb"|[A-Za-z0-9+/_-]{4}[ \t]*(?:[\r\n]|\\[rn])")
#: Bytes of one expanded layer. Data that expands beyond it is searched in overlapping
#: layers of this size, one at a time, and reported as ``oversize`` as well: what is
#: compressed once more inside may be cut there.
LAYER_BYTES = 64 * 1024 * 1024
OVERLAP_BYTES = 1024 * 1024
#: Bytes that deflate without a header has to give.
LEAST_BARE = 12
#: Bytes that a decompressor is given and asked for at a time.
_FEED, _PIECE = 4096, 1024 * 1024


class Layer:
    """A decoded text that knows where its characters come from.

    This one is the original itself.
    """

    #: Whether each character is a byte.
    raw = False

    def __init__(self, text: str) -> None:
        self.text = text

    def span(self, start: int, end: int) -> tuple[int, int]:
        """Place in the original text of the characters ``start`` to ``end``."""
        return start, end


class Replaced(Layer):
    """A layer with runs of escapes decoded: piece ``i`` begins at character ``starts[i]`` and
    at ``origin[i]`` of the layer below, where it ends at ``ends[i]``. A decoded run comes
    from the whole of its escapes, other pieces character by character."""

    def __init__(self, below: Layer, text: str, starts: array, origin: array, ends: array, decoded: bytes) -> None:
        super().__init__(text)
        self.below, self.starts, self.origin, self.ends, self.decoded = below, starts, origin, ends, decoded

    def span(self, start, end):
        first, last = bisect_right(self.starts, start) - 1, bisect_right(self.starts, end - 1) - 1
        begin = self.origin[first] + (0 if self.decoded[first] else start - self.starts[first])
        stop = self.ends[last] if self.decoded[last] else self.origin[last] + end - self.starts[last]
        return self.below.span(begin, stop)


class Bytes(Layer):
    """Bytes of base64, a character each: six bits of every letter from ``skip`` on. Piece
    ``i`` of the letters begins at ``firsts[i]`` and at ``places[i]`` of the layer below."""

    raw = True

    def __init__(self, below: Layer, text: str, firsts: list[int], places: list[int], skip: int) -> None:
        super().__init__(text)
        self.below, self.firsts, self.places, self.skip = below, firsts, places, skip

    def _place(self, letter: int) -> int:
        k = bisect_right(self.firsts, letter) - 1
        return self.places[k] + letter - self.firsts[k]

    def span(self, start, end):
        return self.below.span(self._place(self.skip + start * 8 // 6), self._place(self.skip - (-end * 8 // 6) - 1) + 1)


class Wide(Layer):
    """Every second byte of a layer of bytes, from ``first`` on."""

    def __init__(self, below: Layer, text: str, first: int) -> None:
        super().__init__(text)
        self.below, self.first = below, first

    def span(self, start, end):
        return self.below.span(self.first + 2 * start, self.first + 2 * end - 1)


class Expanded(Layer):
    """Bytes that were compressed: all of them come from one place of the original."""

    raw = True

    def __init__(self, text: str, place: tuple[int, int]) -> None:
        super().__init__(text)
        self.place = place

    def span(self, start, end):
        return self.place


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """``kind, start, end`` in ``text`` as it stands, per kind from left to right."""
    found = []
    if ":" in text or "=" in text:
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text)
                  if len(m[2]) >= _ASSIGN_CHARS]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)
                  if m.end() - m.start() >= _ACCESS_CHARS]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return found


def _unescape(run: str) -> str:
    if run[0] == "%":
        return unquote_to_bytes(run).decode("utf-8", "replace")
    if run[0] == "&":
        return html.unescape(run)
    if run.startswith("\\u{"):
        code = int(run[3:-1], 16)
        return chr(code) if code < 0x110000 else run
    if run.startswith("\\x"):
        return bytes.fromhex(run.replace("\\x", "")).decode("utf-8", "replace")
    if run.startswith("\\U"):
        code = int(run[2:], 16)
        return chr(code) if code < 0x110000 else run
    units = b"".join(int(x, 16).to_bytes(2, "big") for x in run.split("\\u")[1:])
    return units.decode("utf-16-be", "replace")


def _replaced(layer: Layer, pattern: re.Pattern) -> Layer | None:
    """``layer`` with the runs of ``pattern`` decoded; null if that changes nothing."""
    pieces, starts, origin, ends, decoded = [], array("q"), array("q"), array("q"), bytearray()
    at = length = 0

    def put(piece: str, begin: int, stop: int, is_decoded: bool) -> None:
        nonlocal length
        if piece:
            pieces.append(piece)
            starts.append(length)
            origin.append(begin)
            ends.append(stop)
            decoded.append(is_decoded)
            length += len(piece)

    for match in pattern.finditer(layer.text):
        put(layer.text[at:match.start()], at, match.start(), False)
        put(_unescape(match.group()), *match.span(), True)
        at = match.end()
    put(layer.text[at:], at, len(layer.text), False)
    text = "".join(pieces)
    return None if text == layer.text else Replaced(layer, text, starts, origin, ends, bytes(decoded))


def _worker(data: bytes):
    """A decompressor for what starts with these bytes; null if it is not compressed."""
    if data[:3] == b"\x1f\x8b\x08":
        return zlib.decompressobj(31)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor(lzma.FORMAT_XZ)
    return zlib.decompressobj() if _MAGIC.match(data[:2]) else None


class _Expansion:
    """Data decompressed from a place on, member after member, as far as it is sound.

    ``end`` is the place after the last byte that was read.
    """

    def __init__(self, data: bytes, start: int, bare: bool = False) -> None:
        self.data, self.end, self.bare = data, start, bare

    def _worker(self, start: int):
        """A decompressor for what starts here. ``bare`` deflate has no mark of its own and
        is taken to start where the data does."""
        if self.bare:
            return zlib.decompressobj(-15) if start == 0 else None
        return _worker(self.data[start:start + 8])

    def _member(self, start: int, feed: int) -> Iterator[bytes]:
        worker, at = self._worker(start), start
        while not worker.eof and at < len(self.data):
            given = self.data[at:at + feed]
            at += len(given)
            while True:
                yield worker.decompress(given, _PIECE)
                given = getattr(worker, "unconsumed_tail", b"")
                if worker.eof or not (given or not getattr(worker, "needs_input", True)):
                    break
            self.end = at - len(worker.unused_data)

    def pieces(self) -> Iterator[bytes]:
        while self._worker(self.end) is not None:
            start, given = self.end, 0
            try:
                for piece in self._member(start, _FEED):
                    given += len(piece)
                    yield piece
            except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
                # Byte by byte, all that comes before the fault is had.
                try:
                    for piece in self._member(start, 1):
                        rest, given = piece[given:], max(given - len(piece), 0)
                        yield rest
                except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
                    return
            if self.end <= start:
                return


def _expanded(layer: Layer) -> Iterator[Layer | tuple[int, int]]:
    """Layers for the compressed data in a layer of bytes; a span where there are several."""
    data = layer.text.encode("latin-1")
    if isinstance(layer, Bytes):
        yield from _bare_deflate(layer, data)
    match = _MAGIC.search(data)
    while match:
        if not _begins(data, match.start()):
            match = _MAGIC.search(data, match.start() + 1)
            continue
        expansion, held, large = _Expansion(data, match.start()), bytearray(), False

        def made(expansion=expansion, start=match.start()) -> Layer:
            return Expanded(held.decode("latin-1"), layer.span(start, max(expansion.end, start + 1)))

        for piece in expansion.pieces():
            held += piece
            while len(held) > LAYER_BYTES:
                more = bytes(held[LAYER_BYTES - min(OVERLAP_BYTES, LAYER_BYTES // 2):])
                del held[LAYER_BYTES:]
                yield made()
                held, large = bytearray(more), True
        if held:
            yield made()
        if large:
            yield layer.span(match.start(), max(expansion.end, match.start() + 1))
        match = _MAGIC.search(data, max(expansion.end, match.start() + 1) if held else match.start() + 1)


def _begins(data: bytes, start: int) -> bool:
    """Whether the first bytes of compressed data are sound; most chance marks are not."""
    try:
        _worker(data[start:start + 8]).decompress(data[start:start + 64], 64)
    except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
        return data[start] & 0x0F != 8  # only zlib has a mark as short as that
    return True


def _bare_deflate(layer: Layer, data: bytes) -> Iterator[Layer]:
    """Deflate without a header: any bytes may begin like it, so only what is sound from
    the start to an end mark, or long, counts."""
    expansion, held = _Expansion(data, 0, True), bytearray()
    for piece in expansion.pieces():
        held += piece
        if len(held) > LAYER_BYTES:
            yield Expanded(held.decode("latin-1"), layer.span(0, len(data)))
            held = held[-OVERLAP_BYTES:]
    if len(held) >= LEAST_BARE:
        yield Expanded(held.decode("latin-1"), layer.span(0, max(expansion.end, 1)))


def _wide(layer: Layer) -> Iterator[Layer]:
    """Characters of two bytes, whichever of them comes first."""
    data = layer.text.encode("latin-1")
    if not _WIDE.search(data):
        return
    letters = np.frombuffer(data, np.uint8)
    zero = np.zeros(len(letters) + 2, bool)
    zero[1:-1] = letters == 0
    for first in (0, 1):
        at = np.arange(first, len(letters), 2)
        own = np.where(zero[at] | zero[at + 2], letters[at], ord("?")).astype(np.uint8)
        yield Wide(layer, own.tobytes().decode("latin-1"), first)


def _letters(text: str) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Letters of each run of base64, and where its pieces start in the run and in the text."""
    for match in _BASE64.finditer(text):
        yield match.group().rstrip("="), [(0, match.start())]
    for match in _WRAPPED.finditer(text):
        lines, places, size, at = [], [], 0, match.start()
        for gap in [*_BREAK.finditer(text, match.start(), match.end()), None]:
            line = text[at:gap.start() if gap else match.end()].rstrip("=")
            lines.append(line)
            places.append((size, at))
            size, at = size + len(line), gap.end() if gap else at
        if size >= 16:
            yield "".join(lines), places


def _encoded(layer: Layer) -> Iterator[Layer]:
    """Layers of bytes for each run of base64, in the four ways to begin it.

    Letters of a path or word before the data belong to its run, so it may start anywhere.
    """
    for letters, places in _letters(layer.text):
        letters = letters.replace("-", "+").replace("_", "/")
        firsts = [p[0] for p in places]
        for skip in range(4):
            run = letters[skip:]
            run = run[:-1] if len(run) % 4 == 1 else run
            data = base64.b64decode(run + "=" * (-len(run) % 4))
            if _WORTH.search(data) or _MAGIC.search(data) or _WIDE.search(data) or _is_deflate(data):
                yield Bytes(layer, data.decode("latin-1"), firsts, [p[1] for p in places], skip)


def _is_deflate(data: bytes) -> bool:
    """Whether bare deflate may start here, by what a few bytes give."""
    try:
        return len(zlib.decompressobj(-15).decompress(data[:256], LEAST_BARE)) >= LEAST_BARE
    except zlib.error:
        return False


def _unwrapped(layer: Layer) -> Iterator[Layer | tuple[int, int]]:
    for opener, pattern in (("%", _PERCENT), ("\\", _ESCAPES), ("&", _REFERENCES)):
        if opener in layer.text and (inner := _replaced(layer, pattern)) is not None:
            yield inner
    yield from _encoded(layer)
    if layer.raw:
        yield from _wide(layer)
        yield from _expanded(layer)


def scan_text(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Findings in the text as it stands, and all findings, each by place in the original."""
    base = find_secrets(text)
    found = {*base}
    whole = Layer(text)
    # What a layer unwraps to is made when its turn comes, so few layers are held at a time.
    waiting, known = [iter([whole])], set()
    while waiting:
        layer = next(waiting[-1], None)
        if layer is None:
            waiting.pop()
            continue
        if not isinstance(layer, Layer):
            found.add(("oversize", *layer))
            continue
        # A layer met before at the same place ends a cycle of decodings.
        mark = (hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(),
                layer.span(0, len(layer.text))) if layer is not whole and layer.text else None
        if mark in known or not layer.text:
            continue
        known.add(mark)
        if layer is not whole:
            found.update((kind, *layer.span(a, b)) for kind, a, b in find_secrets(layer.text))
        waiting.append(_unwrapped(layer))
    return base, list(found)


def listed(spans: list[tuple[str, int, int]]) -> str:
    """``kind:start:end`` by start, then kind as listed, joined by commas."""
    order = {kind: i for i, kind in enumerate(KINDS)}
    spans = sorted(spans, key=lambda s: (s[1], order.get(s[0], len(order)), s[2]))
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    The counts and the digest are of the findings in the text as it stands; ``spans`` has
    these and those found in decoded layers, in code points of the original. A null text
    is an empty one and has none. Repeated ids give a row each, an empty table none; other
    columns are not looked at. Each text is worked on by itself, so nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for value in batch.column(1):
                base, found = scan_text(value.as_py() or "")
                for out, kind in zip(columns, KINDS, strict=False):
                    out.append(sum(s[0] == kind for s in base))
                columns[3].append(hashlib.sha256(listed(base).encode()).hexdigest())
                columns[4].append(listed(found))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns, kinds)],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, "
             "base_sha256 string, spans string")
