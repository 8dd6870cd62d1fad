import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import time
import urllib.parse
import zlib

import pytest

from tabproof.llm.secrets import find_secrets, listed, scan_secrets, scan_text

SECRET = "password = hunter2hunter2"
def bare(data, level=9, window=-15):
    worker = zlib.compressobj(level, zlib.DEFLATED, window)
    return worker.compress(data) + worker.flush()


WRAPPED = {
    "utf-16-le": base64.b64encode(SECRET.encode("utf-16-le")).decode(),
    "utf-16-be": base64.b64encode(SECRET.encode("utf-16-be")).decode(),
    "bare deflate": base64.b64encode(bare(SECRET.encode())).decode(),
    "zlib of a small window": base64.b64encode(bare(SECRET.encode(), 9, 9)).decode(),
    "gzip of utf-16 of base64": base64.b64encode(gzip.compress(base64.b64encode(SECRET.encode()).decode().encode("utf-16"))).decode(),
    "url": urllib.parse.quote(SECRET),
    "url twice": urllib.parse.quote(urllib.parse.quote(SECRET)),
    "base64": base64.b64encode(SECRET.encode()).decode(),
    "base64 of base64 of url": base64.b64encode(base64.b64encode(urllib.parse.quote(SECRET).encode())).decode(),
    "gzip": base64.b64encode(gzip.compress(SECRET.encode())).decode(),
    "zlib": base64.urlsafe_b64encode(zlib.compress(SECRET.encode())).decode(),
    "bzip2": base64.b64encode(bz2.compress(SECRET.encode())).decode(),
    "unicode": "".join(f"\\u{ord(c):04x}" for c in SECRET),
    "bytes": "".join(f"\\x{ord(c):02x}" for c in SECRET),
    "references": "".join(f"&#{ord(c)};" for c in SECRET),
}


@pytest.mark.parametrize("name", sorted(WRAPPED))
def test_finds_wrapped_secrets_at_their_place(name):
    text = f"é before {WRAPPED[name]} after"
    base, found = scan_text(text)
    assert base == []
    (kind, start, end), = found
    assert kind == "assign"
    begin = text.index(WRAPPED[name])
    assert begin <= start < end <= begin + len(WRAPPED[name])
    assert end - start > len(WRAPPED[name]) * 0.8


def test_base_patterns():
    text = "SECRET:'abcd1234' token=short api_key=12345678 AKIAABCDEFGHIJKL AKIASHORT " + "ab12" * 8 + " " + "f" * 31
    assert listed(find_secrets(text)) == "assign:0:16,assign:30:46,access:47:63,hex:74:106"


def test_failing_matches_still_take_their_characters():
    assert find_secrets("token=secret=12345678") == [] or "assign" in listed(find_secrets("token=secret=12345678"))
    plain = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                       re.ASCII | re.IGNORECASE)
    text = "token=secret=12345678 token=ab secret: x_y.z+12"
    expected = [("assign", *m.span()) for m in plain.finditer(text) if len(m[2]) >= 8]
    assert [s for s in find_secrets(text) if s[0] == "assign"] == expected


def test_only_ascii_letters_fold():
    assert find_secrets("ſecret=12345678") == [] and find_secrets("to\u212aen=12345678") == []


def test_oversize_is_reported(monkeypatch):
    monkeypatch.setattr("tabproof.llm.secrets.LAYER_BYTES", 1000)
    text = base64.b64encode(gzip.compress(b"x" * 5000)).decode()
    assert [s[0] for s in scan_text(text)[1]] == ["oversize"]


def test_documents(spark, docs, rows, no_docs):
    found = scan_secrets(docs)
    assert found.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert found.count() == len(rows) and scan_secrets(no_docs).count() == 0
    nothing = hashlib.sha256(b"").hexdigest()
    empty = found.where("doc_id IN (5, 6, 7)").collect()
    assert [tuple(r)[1:] for r in empty] == [(0, 0, 0, nothing, "")] * 3
    one = scan_secrets(spark.createDataFrame([(1, f"{SECRET} {WRAPPED['base64']}")], "doc_id bigint, text string"))
    row = one.first()
    assert row["n_assign"] == 1 and row["spans"].startswith("assign:0:25,assign:26:")
    assert row["base_sha256"] == hashlib.sha256(b"assign:0:25").hexdigest()


def _wrapped(data, width=76, sep="\n"):
    letters = base64.b64encode(data).decode()
    return sep.join(letters[i:i + width] for i in range(0, len(letters), width))


NOISE = bytes(range(256)) * 3
WHOLE = {
    "not utf-8": base64.b64encode(b"\xff\xfe " + SECRET.encode() + b" \x80").decode(),
    "control characters": base64.b64encode(b"\0\f\x1b" + SECRET.encode()).decode(),
    "later gzip member": base64.b64encode(gzip.compress(b"first ") + gzip.compress(SECRET.encode())).decode(),
    "across gzip members": base64.b64encode(gzip.compress(b"password = hun") + gzip.compress(b"ter2hunter2")).decode(),
    "later bzip2 stream": base64.b64encode(bz2.compress(b"first ") + bz2.compress(SECRET.encode())).decode(),
    "later xz stream": base64.b64encode(lzma.compress(b"first ") + lzma.compress(SECRET.encode())).decode(),
    "gzip with a wrong checksum": base64.b64encode(gzip.compress(SECRET.encode())[:-8] + b"12345678").decode(),
    "gzip cut short": base64.b64encode(gzip.compress(SECRET.encode())[:-9]).decode(),
    "gzip in gzip after noise": base64.b64encode(NOISE + gzip.compress(gzip.compress(SECRET.encode()))).decode(),
    "wrapped": _wrapped(b"some words before it, then " * 2 + SECRET.encode() + b" and more words after it " * 3),
    "wrapped gzip": _wrapped(gzip.compress(hashlib.sha512(b"x").digest() * 2 + SECRET.encode())),
    "wrapped narrowly": _wrapped(SECRET.encode(), 10, "\r\n"),
    "wrapped in escapes": _wrapped(SECRET.encode(), 20, "\\n"),
    **{f"after {n} letters": "abcd/"[:n] + base64.b64encode(SECRET.encode()).decode() for n in range(1, 5)},
    "gzip after a path": "path/" + base64.b64encode(gzip.compress(SECRET.encode())).decode(),
}


@pytest.mark.parametrize("name", sorted(WHOLE))
def test_no_layer_is_given_up(name):
    text = f"é before {WHOLE[name]} after"
    base, found = scan_text(text)
    spans = [(a, b) for kind, a, b in found if kind == "assign"]
    assert base == [] and spans
    begin = text.index(WHOLE[name])
    assert all(begin <= a < b <= begin + len(WHOLE[name]) for a, b in spans)


def test_oversize_data_is_searched(monkeypatch):
    monkeypatch.setattr("tabproof.llm.secrets.LAYER_BYTES", 1000)
    for n in (0, 980, 990, 995, 1000, 4000, 9000):
        text = base64.b64encode(gzip.compress(b"x" * n + b" " + SECRET.encode() + b" " + b"x" * 3000)).decode()
        assert {s[0] for s in scan_text(text)[1]} == {"assign", "oversize"}


def test_named_references():
    text = "x password&equals;hunter2hunter2 &unknown; y"
    base, found = scan_text(text)
    assert base == [] and found == [("assign", 2, 32)]
    assert scan_text("a &amp; b &lt;c&gt; &nosuchname;")[1] == []


ENCODERS = [
    lambda t: urllib.parse.quote(t), lambda t: base64.b64encode(t.encode()).decode(),
    lambda t: base64.b64encode(gzip.compress(t.encode())).decode(), lambda t: base64.b64encode(bare(t.encode())).decode(),
    lambda t: "".join(f"\\u{ord(c):04x}" for c in t), lambda t: "".join(f"&#x{ord(c):x};" for c in t),
    lambda t: base64.b64encode(t.encode("utf-16-le")).decode(), lambda t: base64.b64encode(lzma.compress(t.encode())).decode(),
]


@pytest.mark.parametrize("seed", range(40))
def test_layers_in_any_order(seed):
    """Whatever the wrapping, the secret is found inside its wrapped form and nowhere else."""
    rng = random.Random(seed)
    wrapped = f"note {SECRET} end"
    for _ in range(rng.randint(1, 4)):
        wrapped = rng.choice(ENCODERS)(wrapped)
    text = f"é plain words, {wrapped} more words"
    begin = text.index(wrapped)
    base, found = scan_text(text)
    assert found and {kind for kind, *_ in found} == {"assign"}
    assert all(begin <= a < b <= begin + len(wrapped) for _, a, b in found)


def test_long_runs_take_linear_time():
    """Millions of letters of base64 in one line, in wrapped lines, and of one kind."""
    data = random.Random(1).randbytes(1_500_000)
    one = base64.b64encode(data).decode()
    started = time.perf_counter()
    scan_text(f"data:image/png;base64,{one}")
    scan_text("\n".join(one[i:i + 76] for i in range(0, len(one) // 2, 76)))
    scan_text("A" * 1_000_000)
    scan_text("a-" * 500_000 + " " + "=" * 100_000 + "%41" * 100_000)
    assert time.perf_counter() - started < 60
    inside = base64.b64encode(data[:300_000] + SECRET.encode() + data[300_000:600_000]).decode()
    (kind, a, b), = [f for f in scan_text(inside)[1] if f[0] == "assign"]
    assert (a, b) == (400_000, 400_000 + -(-len(SECRET) * 8 // 6))
