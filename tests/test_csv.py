import hashlib

import pytest

from tabproof.errors import (
    InvalidTableError, SourceFormatError, SourceNotFoundError, SourceReadError,
)
from tabproof.sources.csv import (
    file_manifest, fingerprint, load_and_validate, load_training_table, read_strict_csv,
)
from tabproof.sources.shared import shared_folder
from tests.conftest import CLEAN_ROWS, HEADER


@pytest.fixture
def write(tmp_path):
    def build(content, name="data.csv"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
        return str(path)
    return build


@pytest.fixture
def clean_csv(write):
    return write(HEADER + "\n" + "\n".join(",".join(map(str, r)) for r in CLEAN_ROWS) + "\n")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_clean_file(spark, clean_csv, contract):
    df, report = load_and_validate(spark, clean_csv, contract)
    assert df.columns == HEADER.split(",")
    assert dict(df.dtypes)["BMI"] == "double" and dict(df.dtypes)["Age"] == "bigint"
    assert rows(df) == CLEAN_ROWS
    assert report.is_valid and report.source == clean_csv


def test_upper_case_suffix(spark, write):
    assert rows(read_strict_csv(spark, write("a\n1\n", "DATA.CSV"))) == [(1,)]


@pytest.mark.parametrize("name", ["d.txt", "d.parquet", "d", "d.csv.gz"])
def test_other_suffixes(spark, write, name):
    with pytest.raises(SourceFormatError):
        read_strict_csv(spark, write("a\n1\n", name))


def test_missing_location(spark, tmp_path):
    with pytest.raises(SourceNotFoundError):
        read_strict_csv(spark, str(tmp_path / "absent.csv"))


@pytest.mark.parametrize("content, reason", [
    ("", "empty"),
    ('a,b\n1,"2\n', "never closed"),
    ("a,b\n1,2,3,4\n", "more values"),
    ("a,b\n1,2\n1,2,3\n", "more values"),
    ('a,b\n"x,y","p","q,r"\n', "more values"),
    (b"a,b\n\xff\xfe\xfa,1\n", "UTF-8"),
    ("a,a\n1,2\n", "repeat"),
])
def test_malformed_files(spark, write, content, reason):
    with pytest.raises(SourceReadError, match=reason):
        read_strict_csv(spark, write(content))


def test_header_only(spark, write, contract):
    df, report = load_and_validate(spark, write(HEADER + "\n"), contract)
    assert len(df.columns) == 9 and df.count() == 0
    assert [r["code"] for r in report.issue_rows] == ["EMPTY_DATASET"]


def test_short_rows_are_padded(spark, write):
    assert rows(read_strict_csv(spark, write("a,b,c\n1,2\n3,4,5\n"))) == [(1, 2, None), (3, 4, 5)]


def test_commas_and_quotes_inside_fields(spark, write):
    df = read_strict_csv(spark, write('a,b\n"x,y",1\n"say ""hi""",2\n'))
    assert rows(df) == [("x,y", 1), ('say "hi"', 2)]


def test_quoted_line_breaks(spark, write):
    df = read_strict_csv(spark, write('a,b\n"x\ny",1\nz,2\n'))
    assert sorted(rows(df)) == [("x\ny", 1), ("z", 2)]


def test_over_long_row_with_a_quoted_line_break(spark, write):
    with pytest.raises(SourceReadError, match="more values"):
        read_strict_csv(spark, write('a,b\n"x\ny",1\nz,2,3\n'))


def test_missing_tokens_and_types(spark, write):
    df = read_strict_csv(spark, write(
        "i,d,b,s,e,big\n1,1.5,True,x,NA,1\n NA,NaN,,null,,99999999999999999999\n-3,1e3,false,,n/a,2\n"
        "+4,.5,TRUE,N/A,None,3\n"))
    assert dict(df.dtypes) == dict(
        i="string", d="double", b="boolean", s="string", e="double", big="double")
    assert [r["d"] for r in df.collect()] == [1.5, None, 1000.0, .5]
    assert [r["s"] for r in df.collect()] == ["x", None, None, None]
    assert [r["e"] for r in df.collect()] == [None] * 4


def test_numbers_with_suffix_letters_are_text(spark, write):
    df = read_strict_csv(spark, write("a,b,c\n1d,0x1,inf\n2f,2,-Infinity\n"))
    assert dict(df.dtypes) == dict(a="string", b="string", c="double")
    assert [r["c"] for r in df.collect()] == [float("inf"), float("-inf")]


def test_spaces_around_numbers(spark, write):
    df = read_strict_csv(spark, write("a,b\n 1,2.5 \n3 , 4\n"))
    assert dict(df.dtypes) == dict(a="bigint", b="double")
    assert rows(df) == [(1, 2.5), (3, 4.0)]


def test_folder_of_parts(spark, write, tmp_path):
    write("a,b\n1,x\n", "parts/one.csv")
    write("a,b\n2,y\n", "parts/two.csv")
    assert sorted(rows(read_strict_csv(spark, str(tmp_path / "parts")))) == [(1, "x"), (2, "y")]
    write("b,a\n2,y\n", "parts/three.csv")
    with pytest.raises(SourceReadError):
        read_strict_csv(spark, str(tmp_path / "parts"))


def test_fingerprint(spark, write, tmp_path):
    path = write("a\n1\n", "p/one.csv")
    digest = hashlib.sha256(b"a\n1\n").hexdigest()
    assert fingerprint(spark, path) == digest
    write("a\n2\n", "p/two.csv")
    both = sorted([digest, hashlib.sha256(b"a\n2\n").hexdigest()])
    assert fingerprint(spark, str(tmp_path / "p")) == hashlib.sha256("\n".join(both).encode()).hexdigest()
    assert fingerprint(spark, str(tmp_path / "absent.csv")) == ""
    assert {r["length"] for r in file_manifest(spark, str(tmp_path / "p")).collect()} == {4}


def test_training_table(spark, write, clean_csv, contract):
    df, digest = load_training_table(spark, clean_csv, contract)
    assert df.count() == 4 and len(digest) == 64
    bad = write(HEADER + "\n6,-1,72,35,100,33.6,0.627,50,1\n", "bad.csv")
    with pytest.raises(InvalidTableError) as caught:
        load_training_table(spark, bad, contract)
    assert caught.value.report.source == bad


def test_shared_folder_uses_the_session_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert a.startswith(base) and a != b
