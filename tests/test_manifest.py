import gzip

import pytest

from voltide.sources import manifest as m


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "abc.us.txt").write_text("Date,Open,High,Low,Close,Volume,OpenInt\n2001-01-02,1,2,0.5,1.5,10,0\nxx,1,2,0.5,1.5,10,0\n")
    (tmp_path / "DEF.us.txt").write_text('\n"Close", HIGH,low,open,date\n"1.5",2,0.5,1,2001-01-03\n7\n')
    (tmp_path / "g h.us.txt").write_text("date,open,high,low,close,volume\nno,1,2,3,4,5\n")
    (tmp_path / "nil.us.txt").write_text("")
    (tmp_path / "blank.us.txt").write_text("\n  \n")
    (tmp_path / "short.us.txt").write_text("Date,Open\n2001-01-02,1\n")
    whole = gzip.compress(b"Date,Open,High,Low,Close\n2001-01-02,1,2,1,2\n")
    (tmp_path / "bad.us.txt.gz").write_bytes(b"\x1f\x8b" + b"\x00" * 8 + whole[20:])
    return f"{tmp_path}/*.us.txt*"


def test_each_file_has_a_row(spark, folder):
    got = {r["series_id"]: (r["bytes"] > 0, r["header"] and len(r["header"]), r["error"]) for r in m.file_manifest(spark, folder).collect()}
    assert got == {
        "abc": (True, 7, None),
        "def": (True, 5, None),
        "g h": (True, 6, None),
        "nil": (False, None, "empty file"),
        "blank": (True, None, "no readable line"),
        "short": (True, 2, "missing columns: high, low, close"),
        "bad": (True, None, "no readable line"),
    }


def test_headers_of_their_own(spark, folder):
    got = m.read_files(spark, folder).orderBy("series_id").collect()
    assert [tuple(map(str, r)) for r in got] == [
        ("abc", "2001-01-02", "1.0", "2.0", "0.5", "1.5", "10.0"),
        ("def", "2001-01-03", "1.0", "2.0", "0.5", "1.5", "None"),
    ]


def test_report_names_every_series(spark, folder):
    got = {r["series_id"]: (r["n_rows"], r["error"]) for r in m.qa_report_of_files(spark, folder).collect()}
    assert got == {
        "abc": (1, None),
        "def": (1, None),
        "g h": (None, "no bar"),
        "nil": (None, "empty file"),
        "blank": (None, "no readable line"),
        "short": (None, "missing columns: high, low, close"),
        "bad": (None, "no readable line"),
    }


def test_only_broken_files(spark, tmp_path):
    (tmp_path / "nil.us.txt").write_text("")
    path = f"{tmp_path}/*.txt"
    assert m.read_files(spark, path).count() == 0
    assert [r["error"] for r in m.qa_report_of_files(spark, path).collect()] == ["empty file"]
