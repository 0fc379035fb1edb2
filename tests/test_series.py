from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from croptide.functions import closing_monday
from croptide.operators import series

MON = date(2020, 1, 6)  # a Monday


def rows(spark, *items):
    return spark.createDataFrame(list(items), "series string, date date, value double")


def weeks(spark, values, name="a", start=MON):
    return spark.createDataFrame(
        [(name, start + timedelta(weeks=i), v) for i, v in enumerate(values)],
        "series string, week date, value double")


def got(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns[:2])).collect()]


def test_marketing_calendar(spark):
    df = spark.createDataFrame(
        [(date(2009, 6, 1),), (date(2009, 8, 31),), (date(2009, 9, 1),), (date(2009, 12, 31),),
         (date(2010, 2, 28),), (date(2010, 3, 1),), (date(2010, 5, 31),), (date(2099, 7, 1),)],
        "date date")
    assert [tuple(r)[1:] for r in series.marketing_calendar(df).orderBy("date").collect()] == [
        ("2009/10", 1, "Jun"), ("2009/10", 1, "Aug"), ("2009/10", 2, "Sep"),
        ("2009/10", 3, "Dec"), ("2009/10", 3, "Feb"), ("2009/10", 4, "Mar"),
        ("2009/10", 4, "May"), ("2099/00", 1, "Jul")]


def test_closing_monday(spark):
    df = spark.createDataFrame([(MON + timedelta(days=i),) for i in range(-7, 9)], "d date")
    for r in df.select("d", closing_monday("d").alias("m")).collect():
        assert r["m"].weekday() == 0 and 0 <= (r["m"] - r["d"]).days <= 6


def test_expand_annual(spark):
    df = spark.createDataFrame([(date(2009, 6, 1), 5.0)], "date date, acres double")
    out = got(series.expand_annual(df))
    assert len(out) == 12 and out[0] == (date(2009, 6, 1), 5.0)
    assert out[-1] == (date(2010, 5, 1), 5.0)


def test_disaggregate_quarterly_sums_back(spark):
    df = spark.createDataFrame(
        [(date(2009, 12, 1), 10.0, 7.0)],
        "date date, US_Exports_M_Bu double, US_Ending_Stocks_M_Bu double")
    out = got(series.disaggregate_quarterly(df))
    assert [r[0] for r in out] == [date(2009, 12, 1), date(2010, 1, 1), date(2010, 2, 1)]
    assert sum(r[1] for r in out) == pytest.approx(10.0) and {r[2] for r in out} == {7.0}
    long = rows(spark, ("quarterly_supply.US_Exports_M_Bu", date(2009, 12, 1), 9.0),
                ("US_Total_Supply_M_Bu", date(2009, 12, 1), 9.0))
    by = {s: v for s, _, v in got(series.disaggregate_quarterly(long))}
    assert by == {"quarterly_supply.US_Exports_M_Bu": 3.0, "US_Total_Supply_M_Bu": 9.0}


def test_hold_to_monthly(spark):
    df = rows(spark, ("g", date(2020, 1, 1), 1.0), ("g", date(2020, 4, 15), 2.0),
              ("g", date(2020, 7, 1), None))
    out = got(series.hold_to_monthly(df, "2019-12-01", "2020-09-30"))
    assert [r[2] for r in out] == [None, 1.0, 1.0, 1.0, 2.0, 2.0, 2.0, 2.0, 2.0, 2.0]
    assert [r[1] for r in out] == [date(2019, 12, 1)] + [date(2020, m, 1) for m in range(1, 10)]
    later = got(series.hold_to_monthly(df, "2020-05-01", "2020-06-30"))
    assert [r[2] for r in later] == [2.0, 2.0]


def test_resample_weekly(spark):
    df = rows(spark, ("a", MON, 1.0), ("a", MON + timedelta(1), 2.0),
              ("a", MON + timedelta(6), 5.0), ("a", MON + timedelta(7), None),
              ("a", MON + timedelta(8), None))
    nxt, third = MON + timedelta(7), MON + timedelta(14)
    assert got(series.resample_weekly(df, "sum")) == [
        ("a", MON, 1.0), ("a", nxt, 7.0), ("a", third, None)]
    assert got(series.resample_weekly(df, "mean"))[1] == ("a", nxt, 3.5)
    # The last row of the week is missing: the last known value counts.
    assert got(series.resample_weekly(df, "last"))[1] == ("a", nxt, 5.0)
    b = df.withColumn("series", F.lit("b"))
    mixed = got(series.resample_weekly(df.unionByName(b), {"a": "sum"}))
    assert mixed[1] == ("a", nxt, 7.0) and mixed[4] == ("b", nxt, 3.5)
    own = df.withColumn("how", F.lit("last"))
    assert got(series.resample_weekly(own))[1] == ("a", nxt, 5.0)
    with pytest.raises(ValueError):
        series.resample_weekly(df, "mode")


def test_densify_weekly(spark):
    start, end = "2020-01-01", "2020-02-09"  # Mondays 6 Jan … 3 Feb
    df = spark.createDataFrame(
        [("a", MON + timedelta(7), 1.0), ("a", MON + timedelta(21), None),
         ("old", date(2019, 1, 7), 9.0), ("new", date(2021, 1, 4), 9.0),
         ("wide", date(2019, 12, 30), 3.0), ("wide", MON, 4.0), ("wide", date(2020, 3, 2), 5.0)],
        "series string, week date, value double")
    out = {}
    for s, w, v in got(series.densify_weekly(df, start, end)):
        out.setdefault(s, []).append((w, v))
    mondays = [MON + timedelta(weeks=i) for i in range(5)]
    assert {s: [w for w, _ in x] for s, x in out.items()} == dict.fromkeys(
        ("a", "old", "new", "wide"), mondays)
    assert [v for _, v in out["a"]] == [None, 1.0, None, None, None]
    assert [v for _, v in out["wide"]] == [4.0, None, None, None, None]
    assert {v for s in ("old", "new") for _, v in out[s]} == {None}


def test_densify_refuses_repeated_weeks(spark):
    twice = weeks(spark, [1.0]).unionByName(weeks(spark, [2.0]))
    with pytest.raises(Exception, match="two rows of one series in week 2020-01-06"):
        series.densify_weekly(twice, "2020-01-01", "2020-02-01").collect()


def test_fills(spark):
    df = weeks(spark, [None, 1.0, None, None, 2.0, None])
    filled = series.ffill(df)
    assert [v for *_, v in got(filled)] == [None, 1.0, 1.0, 1.0, 2.0, 2.0]
    assert got(series.ffill(filled)) == got(filled)
    assert [v for *_, v in got(series.bfill(filled))] == [1.0, 1.0, 1.0, 1.0, 2.0, 2.0]


@pytest.mark.parametrize("gap", [10, 11])
def test_bfill_reaches_ten_rows(spark, gap):
    out = [v for *_, v in got(series.bfill(weeks(spark, [None] * gap + [7.0])))]
    assert out == [None] * (gap - 10) + [7.0] * 11


def test_fills_stay_within_a_series(spark):
    df = weeks(spark, [1.0, None], "a").unionByName(weeks(spark, [None, 5.0], "b"))
    assert [v for *_, v in got(series.ffill(df))] == [1.0, 1.0, None, 5.0]
    assert [v for *_, v in got(series.bfill(df))] == [1.0, None, 5.0, 5.0]


def test_pct_change(spark):
    df = weeks(spark, [4.0, 5.0, 0.0, 3.0, None])
    out = [r[3] for r in got(series.pct_change(df))]
    assert out == [None, 25.0, -100.0, None, None]
    both = df.unionByName(weeks(spark, [1.0], "b"))
    assert series.pct_change(both, "b").count() == 1


def test_merge_weekly(spark):
    daily = rows(spark, *[("ZW=F", MON + timedelta(days=i), float(100 + i)) for i in range(15)])
    monthly = rows(spark, ("US_X", date(2020, 1, 1), 3.0))
    late = rows(spark, ("late", MON + timedelta(14), 8.0), ("late", date(2030, 1, 1), 1.0))
    wide = series.merge_weekly(
        [daily, monthly, late], "2020-01-01", "2020-01-20", {"ZW=F": "last"}).orderBy("Date")
    assert wide.columns == ["Date", "US_X", "ZW=F", "late", "Target_Return"]
    out = [tuple(r) for r in wide.collect()]
    assert [r[0] for r in out] == [MON, MON + timedelta(7), MON + timedelta(14)]
    assert [r[1] for r in out] == [3.0] * 3 and [r[2] for r in out] == [100.0, 107.0, 114.0]
    assert [r[3] for r in out] == [8.0] * 3
    assert out[0][4] is None and out[1][4] == pytest.approx(7.0)
    named = series.merge_weekly([daily], "2020-01-01", "2020-01-20", "last", None, ["ZW=F"])
    assert named.columns == ["Date", "ZW=F"]


def test_merge_holds_what_was_known_before_the_start(spark):
    rows = spark.createDataFrame(
        [("r", date(2009, 12, 1), 1.0), ("r", date(2010, 4, 1), 2.0),
         ("old", date(2009, 1, 5), 9.0), ("late", date(2010, 2, 1), 5.0)],
        "series string, date date, value double")
    out = series.merge_weekly_long([rows], "2010-01-01", "2010-04-12")
    got = {}
    for r in out.orderBy("series", "week").collect():
        got.setdefault(r["series"], []).append(r["value"])
    assert got["r"] == [1.0] * 13 + [2.0] * 2  # weeks from 4 January; April from the 5th
    assert "old" not in got  # nothing within the range
    assert got["late"] == [5.0] * 15  # filled backwards, as nothing was known


def test_nan_and_bad_labels_become_null(spark, tmp_path):
    from croptide.sources import SERIES_KINDS, read_series

    def table(name, *lines):
        path = tmp_path / f"{name}.csv"
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    risk = read_series(spark, table("r", "date,GPR", "2020-01-01,NaN", "x,3", "2020-02-01,4"),
                       "risk")
    assert [(r["date"], r["value"]) for r in risk.collect()] == [
        (date(2020, 1, 1), None), (None, 3.0), (date(2020, 2, 1), 4.0)]
    quarters = read_series(
        spark, table("q", "Marketing_Year,Time_Period,US_Exports_M_Bu", "2009/10,Q3 Dec-Feb,1",
                     "n.a.,Q1 Jun-Aug,2", "2010/11,n.a.,3"), "quarterly_supply")
    assert [(r["date"], r["value"]) for r in quarters.collect()] == [
        (date(2009, 12, 1), 1.0), (None, 2.0), (None, 3.0)]
    # Every published shape has a successful read.
    for kind, shape in SERIES_KINDS.items():
        header = {"marketing_year": "2009/10", "marketing_quarter": "2009/10"}.get(
            shape.calendar, "2009-06-01")
        extra = ",Time_Period" if shape.calendar == "marketing_quarter" else ""
        label = "" if shape.dates[0] == "_c0" else shape.dates[0]
        path = table(kind, label + extra + "," + ",".join(shape.values),
                     header + (",Q1 Jun-Aug" if extra else "") + ",1.5" * len(shape.values))
        rows = read_series(spark, path, kind).collect()
        assert {r["date"] for r in rows} == {date(2009, 6, 1)}, kind
        assert {r["series"] for r in rows} == set(shape.values)
        assert {r["value"] for r in rows} == {1.5}
