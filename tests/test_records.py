import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tabproof.errors import SourceReadError
from tabproof.sources import records
from tabproof.sources.csv import read_strict_csv
from tabproof.sources.records import _cut, _states, csv_records


def some_rows(seed, count):
    """Cells with quotes, separators and all kinds of line breaks."""
    rng = random.Random(seed)
    bits = ['"', ",", "\n", "\r\n", "word", " ", "é漢", '""', "\n\n", "x" * 40]
    return [(str(i), "".join(rng.choices(bits, k=rng.randint(0, 12))), f"t{i}") for i in range(count)]


def as_csv(rows, ending="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=ending, quoting=csv.QUOTE_MINIMAL)
    writer.writerow(["id", "text", "last"])
    writer.writerows(rows)
    return out.getvalue()


@pytest.fixture
def small_ranges(spark, monkeypatch):
    """Ranges and pieces of a few lines, so that records cross many borders."""
    monkeypatch.setattr(records, "PIECE_BYTES", 100)
    settings = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_cut():
    assert _cut(b'a,"b\nc"\nd\n"e\n', False)[::3] == (None, b'"e')
    head, whole, ends, tail = _cut(b'x\n y"\nd,e\n\nf\n', True)
    assert (head, whole, ends.tolist(), tail) == (b'x\n y"', b"d,ef", [3, 3, 4], None)
    assert _cut(b"all\ninside\n", True)[::3] == (b"all\ninside", None)
    assert _cut(b'"open\n', False)[::3] == (None, b'"open')
    assert _cut(b'ends"\n', True)[::3] == (b'ends"', None)


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_records_across_borders(spark, tmp_path, small_ranges, ending):
    folder = tmp_path / "many"
    folder.mkdir()
    expected = []
    for part in range(3):
        rows = some_rows(part, 120)
        expected += rows
        (folder / f"{part}.csv").write_text(as_csv(rows, ending), newline="")
    plain = [(str(i), "plain", "p") for i in range(900, 960)]
    (folder / "plain.csv").write_text(as_csv(plain, ending), newline="")  # a file without breaks in quotes
    (folder / "only_header.csv").write_text(as_csv([], ending), newline="")
    df = read_strict_csv(spark, str(folder))
    found = sorted((str(r["id"]), r["text"] or "", r["last"]) for r in df.collect())
    assert found == sorted(expected + plain)
    pieces = records._pieces(spark, str(folder))
    assert pieces.select("file", "block").distinct().count() > 20
    assert _states(pieces).where("inside AND chain IS NULL").count() == 0


def test_long_record_over_many_ranges(spark, tmp_path, small_ranges):
    text = "\n".join(f"line {i}, with 'quotes' and commas" for i in range(400))
    path = tmp_path / "long.csv"
    path.write_text(as_csv([("1", text, "a"), ("2", "short\n", "b"), ("3", "", "c")]), newline="")
    found = {r["id"]: (r["text"], r["last"]) for r in read_strict_csv(spark, str(path)).collect()}
    assert found == {1: (text, "a"), 2: ("short\n", "b"), 3: (None, "c")}


def test_header_over_lines_and_blank_lines(spark, tmp_path):
    path = tmp_path / "head.csv"
    path.write_text('\n  \n"a\nb",c\n1,"x\ny"\n\n2,z', newline="")
    df = read_strict_csv(spark, str(path))
    assert df.columns == ["a\nb", "c"]
    assert sorted(map(tuple, df.collect())) == [(1, "x\ny"), (2, "z")]


def test_faults(spark, tmp_path):
    folder = tmp_path / "faults"
    folder.mkdir()
    (folder / "a.csv").write_text('a,b\n1,"x\ny"\n')
    (folder / "b.csv").write_text('b,a\n1,"x\ny"\n')
    with pytest.raises(SourceReadError, match="header"):
        read_strict_csv(spark, str(folder))
    (folder / "b.csv").write_text('a,b\n1,"x\ny",3\n')
    with pytest.raises(SourceReadError, match="more values"):
        read_strict_csv(spark, str(folder))
    (folder / "b.csv").write_text('a,a\n1,"x\ny"\n')
    with pytest.raises(SourceReadError):
        read_strict_csv(spark, str(folder / "b.csv"))
    (folder / "b.csv").write_text('a,b\n"x\ny"\n')  # short rows are filled up
    assert read_strict_csv(spark, str(folder / "b.csv")).where(F.col("b").isNull()).count() == 1


def test_records_keep_their_bytes(spark, tmp_path, small_ranges):
    rows = some_rows(77, 200)
    path = tmp_path / "bytes.csv"
    path.write_text(as_csv(rows), newline="")
    found = csv_records(spark, str(path)).where("NOT header").select("record").collect()
    again = list(csv.reader(io.StringIO("\n".join(r["record"] for r in found) + "\n", newline="")))
    assert sorted(map(tuple, again)) == sorted(rows)
