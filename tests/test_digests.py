import hashlib
import random
import time

import pytest

from tabproof.sources import digests
from tabproof.sources.csv import fingerprint
from tabproof.sources.digests import block_digests, file_digests, file_manifest, folder_digest


def sha(content):
    return hashlib.sha256(content).hexdigest()


def by_hand(content, block, fanout):
    nodes = [sha(content[i:i + block]) for i in range(0, len(content), block)]
    while len(nodes) > 1:
        nodes = [sha("".join(nodes[i:i + fanout]).encode()) for i in range(0, len(nodes), fanout)]
    return nodes[0]


@pytest.fixture
def folder(tmp_path):
    rng = random.Random(4)
    contents = {f"f{i}": rng.randbytes(size) for i, size in enumerate((0, 1, 99, 100, 101, 400, 401, 1600, 1601, 7000))}
    contents["copy of f5"] = contents["f5"]
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    return str(tmp_path), {name: c for name, c in contents.items() if c}  # Spark lists no empty files


@pytest.mark.parametrize("whole", [0, 400, 2**20])
@pytest.mark.parametrize(("block", "fanout"), [(100, 4), (1, 50), (10_000, 2)])
def test_equals_definition(spark, folder, monkeypatch, whole, block, fanout):
    """Files read whole and files read by range give the same digests."""
    monkeypatch.setattr(digests, "WHOLE_BYTES", whole)
    path, contents = folder
    found = file_digests(spark, path, block, fanout).collect()
    assert sorted((r["length"], r["digest"]) for r in found) == sorted(
        (len(c), by_hand(c, block, fanout)) for c in contents.values())


@pytest.mark.parametrize("whole", [0, 2**20])
def test_manifest_and_blocks(spark, folder, monkeypatch, whole):
    monkeypatch.setattr(digests, "WHOLE_BYTES", whole)
    path, contents = folder
    found = {r["path"].rsplit("/", 1)[1].replace("%20", " "): (r["length"], r["sha256"]) for r in file_manifest(spark, path).collect()}
    assert found == {name: (len(c), sha(c)) for name, c in contents.items()}
    blocks = block_digests(spark, path, 100).where("length = 401").orderBy("place").collect()
    assert [r["digest"] for r in blocks] == [sha(contents["f6"][i:i + 100]) for i in range(0, 401, 100)]


def test_time_does_not_grow_with_blocks_times_bytes(spark, tmp_path):
    """Copying the file once for each of its 65,536 blocks moves half a terabyte."""
    content = random.Random(5).randbytes(2**23)
    (tmp_path / "many blocks").write_bytes(content)
    started = time.monotonic()
    found = block_digests(spark, str(tmp_path), 128).orderBy("place").collect()
    took = time.monotonic() - started
    assert [r["digest"] for r in found] == [sha(content[i:i + 128]) for i in range(0, len(content), 128)]
    assert took < 30


def test_folder(spark, folder, tmp_path):
    path, contents = folder
    groups = {}
    for content in contents.values():
        digest = by_hand(content, 100, 4)
        groups.setdefault(digest[:3], []).append(digest)
    expected = sha("\n".join(sha("\n".join(sorted(groups[g])).encode()) for g in sorted(groups)).encode())
    assert folder_digest(spark, path, 100, 4) == expected
    (tmp_path / "f1").write_bytes(b"changed")
    assert folder_digest(spark, path, 100, 4) != expected


def test_file_above_two_gigabytes(spark, tmp_path):
    """A sparse file that no single row could hold."""
    size = 2**31 + 12_345
    path = tmp_path / "large.bin"
    with path.open("wb") as file:
        file.truncate(size)
    zeros, whole = bytes(2**20), hashlib.sha256()
    for _ in range(size // 2**20):
        whole.update(zeros)
    whole.update(zeros[:size % 2**20])
    assert fingerprint(spark, str(path)) == whole.hexdigest()
    block = 64 * 2**20
    full, last = sha(bytes(block)), sha(bytes(size % block))
    expected = sha("".join([full] * (size // block) + [last]).encode())
    assert [(r["length"], r["digest"]) for r in file_digests(spark, str(path), block).collect()] == [(size, expected)]


def test_settings(spark, folder):
    with pytest.raises(ValueError, match="fanout"):
        file_digests(spark, folder[0], 100, 1)
