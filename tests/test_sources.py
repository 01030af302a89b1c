import datetime as dt

import pytest

from waybill import sources


def test_run_sql_text_and_file(spark, frame, tmp_path):
    frame("A int, d string", [(1, "2020-01-01"), (2, "2020-02-01")]).createOrReplaceTempView("tiny")
    text = "SELECT a AS TOTAL FROM tiny WHERE d >= :start;"
    path = tmp_path / "q.sql"
    path.write_text(text)
    for source, kind in ((text, "text"), (str(path), "file")):
        got = sources.run_sql(spark, source, kind, start="2020-01-15")
        assert got.columns == ["total"] and got.collect()[0].total == 2
    with pytest.raises(ValueError):
        sources.run_sql(spark, text, "folder")


def test_bound_values_are_not_spliced(spark, frame):
    frame("a string", [("x",)]).createOrReplaceTempView("tiny_text")
    got = sources.run_sql(spark, "SELECT * FROM tiny_text WHERE a = :v", v="x' OR '1'='1")
    assert got.count() == 0


def test_csv_reads_nan_as_null(spark, tmp_path):
    (tmp_path / "t.csv").write_text("k,v\na,1.5\nb,NaN\nc,\n")
    got = sources.read_csv(spark, str(tmp_path / "t.csv"), "k string, v double")
    assert {r.k: r.v for r in got.collect()} == {"a": 1.5, "b": None, "c": None}


def test_series_csv(spark, tmp_path):
    (tmp_path / "s.csv").write_text("DATE,GDP,OTHER\n2020-01-01,1.5,x\n2020-04-01,2.5,y\n")
    got = sources.read_series_csv(
        spark, str(tmp_path / "s.csv"), "DATE string, GDP double, OTHER string", "DATE", "GDP"
    )
    assert [tuple(r) for r in got.orderBy("ts").collect()] == [
        (dt.date(2020, 1, 1), 1.5),
        (dt.date(2020, 4, 1), 2.5),
    ]


def test_calendars(spark, frame):
    assert sources.calendar(spark, "2020-02-27", "2020-03-02").count() == 5
    assert [r.quarter for r in sources.quarters(spark, "2020-01-01", "2020-12-31").collect()] == [
        dt.date(2020, m, 1) for m in (1, 4, 7, 10)
    ]
    empty = frame("d date", []).select("d")
    assert sources.calendar_spanning(empty, "d").count() == 0


def test_sample_is_repeatable(spark):
    df = spark.range(100)
    first = [r.id for r in sources.sample_rows(df, ["id"], 10, seed=1).collect()]
    again = [r.id for r in sources.sample_rows(df.repartition(7), ["id"], 10, seed=1).collect()]
    other = [r.id for r in sources.sample_rows(df, ["id"], 10, seed=2).collect()]
    assert sorted(first) == sorted(again) and sorted(first) != sorted(other)


def test_renames(frame):
    df = frame("A int, B int", [(1, 2)])
    assert sources.lower_names(df).columns == ["a", "b"]
    assert sources.rename_all(df, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError):
        sources.rename_all(df, ["x"])


def test_literal_rows(spark):
    got = sources.from_rows(spark, [(1, "a", None), (2, None, 0.5)], "k int, s string, v double")
    assert sorted(map(tuple, got.collect())) == [(1, "a", None), (2, None, 0.5)]


def test_head_and_tail(frame):
    df = frame("k int", [(3,), (1,), (None,), (2,)])
    assert [r.k for r in sources.head_rows(df, ["k"], 2).collect()] == [1, 2]
    assert [r.k for r in sources.tail_rows(df, ["k"], 2).collect()] == [None, 3]
