import pytest

from voltide.sources import bars as b


def test_read_folder_of_files(spark, tmp_path):
    (tmp_path / "abc.us.txt").write_text(
        "Date,Open,High,Low,Close,Volume,OpenInt\n2001-01-02,1,2,0.5,1.5,10,0\nxx,1,2,0.5,1.5,10,0\n2001-01-03,1,2,0.5,abc,10,0\n"
        "2001-01-04,1,2,0.5,1.5,,0\n1980-01-04,1,2,0.5,1.5,1,0\n"
    )
    (tmp_path / "def.us.txt").write_text("Date,Open,High,Low,Close,Volume,OpenInt\n2001-01-02,3,4,2,3,7,0\n")
    got = b.read_bars(spark, str(tmp_path / "*.txt")).orderBy("series_id", "date").collect()
    assert [(r["series_id"], str(r["date"]), r["volume"]) for r in got] == [
        ("abc", "2001-01-02", 10.0), ("abc", "2001-01-04", None), ("def", "2001-01-02", 7.0)
    ]


def test_missing_column_is_refused(spark):
    with pytest.raises(b.MissingColumns):
        b.clean(spark.createDataFrame([("2001-01-01", "1")], "Date string, Open string"))
