from datetime import date
from types import SimpleNamespace

import pytest
from helpers import day, one_cell
from pyspark.sql import functions as F

from croptide import session
from croptide.operators import indices, quality
from croptide.sinks import (
    clear_stages,
    fingerprint,
    materialize_stage,
    replace_table,
    write_features,
    write_index_store,
    write_missing_partitions,
)
from croptide.sources import read_grid, read_index_store, read_regions, read_series


def test_read_grid(spark, tmp_path):
    path = str(tmp_path / "g")
    df = spark.createDataFrame([(day(0), 1.0, float("nan")), (day(1), 1.0, 2.0)],
                               "forecast_time date, lat double, tp double")
    df.repartition(2).write.parquet(path)
    out = read_grid(spark, path)
    assert out.columns == ["valid_time", "lat", "tp"]
    assert [r["tp"] for r in out.orderBy("valid_time").collect()] == [None, 2.0]
    df.write.option("header", True).csv(str(tmp_path / "c"))
    typed = read_grid(spark, str(tmp_path / "c"), file_format="csv", schema=df.schema)
    assert [r["tp"] for r in typed.orderBy("valid_time").collect()] == [None, 2.0]
    (tmp_path / "empty").mkdir()
    for missing in ("empty", "absent"):
        with pytest.raises(FileNotFoundError):
            read_grid(spark, str(tmp_path / missing))


CELLS = "time date, latitude double, longitude double"


def grid_file(spark, path, columns, rows, **kinds):
    kind = kinds.get("kind", "double")
    frame = spark.createDataFrame(rows, CELLS + "".join(f", {c} {kind}" for c in columns))
    frame.coalesce(1).write.mode("append").parquet(path)


def test_unlike_files_become_one_row_per_cell(spark, tmp_path):
    path = str(tmp_path / "g")
    nan = float("nan")
    grid_file(spark, path, ["t2m"], [(day(0), 1.0, 2.0, 280.0), (day(1), 1.0, 2.0, None)])
    grid_file(spark, path, ["tp"], [(day(0), 1.0, 2.0, 5.0), (day(2), 1.0, 2.0, 7.0)])
    grid_file(spark, path, ["tp", "t2m"], [(day(1), 1.0, 2.0, nan, 281.0),
                                           (day(0), 1.0, 2.0, 5.0, 280.0)])
    out = read_grid(spark, path)
    assert sorted((r["valid_time"], r["t2m"], r["tp"]) for r in out.collect()) == [
        (day(0), 280.0, 5.0), (day(1), 281.0, None), (day(2), None, 7.0)]
    grid_file(spark, path, ["tp"], [(day(2), 1.0, 2.0, 8.0)])
    with pytest.raises(Exception, match="conflicting values of tp at .*longitude=2.0"):
        read_grid(spark, path).collect()


def test_files_of_one_kind_are_only_united(spark, tmp_path):
    path = str(tmp_path / "g")
    for k in range(2):
        grid_file(spark, path, ["t2m", "tp"], [(day(k), 1.0, 2.0, 280.0, 1.0)])
    out = read_grid(spark, path)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    one = str(tmp_path / "one")
    grid_file(spark, one, ["tp"], [(day(0), 1.0, 2.0, 1.0), (day(0), 1.0, 2.0, 2.0)])
    assert read_grid(spark, one).count() == 2  # told apart by nothing: an error later on


def test_unlike_files_other_coordinates(spark, tmp_path):
    """Levels, other spellings and named coordinates keep rows apart; text too."""
    path = str(tmp_path / "g")
    for name, column, kind in (("lat", "t", 1.0), ("latitude", "q", 2.0)):
        frame = spark.createDataFrame(
            [(day(0), 1.0, 2.0, level, 9, site, kind) for level in (500, 850) for site in "ab"],
            f"valid_time date, {name} double, lon double, level int, step int, site string, "
            f"{column} double")
        frame.coalesce(1).write.mode("append").parquet(path)
    out = read_grid(spark, path, coords=["step"])
    assert set(out.columns) == {"valid_time", "latitude", "lon", "level", "step", "site", "t", "q"}
    assert sorted((r["latitude"], r["level"], r["site"], r["t"], r["q"]) for r in out.collect()) == [
        (1.0, level, site, 1.0, 2.0) for level in (500, 850) for site in "ab"]


def test_unlike_types_and_headers_are_errors(spark, tmp_path):
    path = str(tmp_path / "g")
    grid_file(spark, path, ["tp"], [(day(0), 1.0, 2.0, 1.0)])
    grid_file(spark, path, ["tp"], [(day(1), 1.0, 2.0, "x")], kind="string")
    with pytest.raises(Exception, match="(?i)merg"):
        read_grid(spark, path).collect()
    csv = str(tmp_path / "c")
    for column in ("t2m", "tp"):
        spark.createDataFrame([(day(0), 1.0, 2.0, 1.0)], f"{CELLS}, {column} double").write.mode(
            "append").option("header", True).csv(csv)
    with pytest.raises(Exception, match="(?i)header"):
        read_grid(spark, csv, file_format="csv", schema=f"{CELLS}, t2m double").collect()


def test_index_store_round_trip(spark, tmp_path):
    path = str(tmp_path / "store")
    wide = indices.compute_indices(
        one_cell(spark, "tmax", [300.0 + i for i in range(400)]).withColumns({
            "tmin": F.col("tmax"), "precip": F.lit(0.0), "evap": F.lit(1.0),
            "soil": F.lit(None).cast("double"), "u_wind": F.lit(1.0), "v_wind": F.lit(0.0)}))
    write_index_store(wide.limit(3), path)
    write_index_store(wide, path)  # replaces
    back = read_index_store(spark, path)
    kinds = {f.name: f.dataType.simpleString() for f in back.schema.fields}
    assert back.count() == 400
    assert kinds["GDD"] == "float" and kinds["HeatwaveIndex"] == "smallint"
    assert back.schema["SPI"].metadata["window_days"] == 30
    assert back.filter("year = 2021").count() == 34
    with pytest.raises(FileNotFoundError):
        read_index_store(spark, str(tmp_path / "none"))


def files_below(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file())


def test_a_write_that_fails_leaves_the_old_store(spark, tmp_path):
    path = tmp_path / "store"
    good = one_cell(spark, "GDD", [1.0, 2.0, 3.0])
    write_index_store(good, str(path))
    before = files_below(path)
    late = good.withColumn("GDD", F.when(F.col("GDD") > 2, F.raise_error(F.lit("half-way")))
                           .otherwise(F.col("GDD"))).repartition(3, "GDD")
    with pytest.raises(Exception, match="half-way"):
        write_index_store(late, str(path))
    assert files_below(path) == before
    assert [p.name for p in tmp_path.iterdir()] == ["store"]  # nothing is left beside it
    # A table can be replaced by what is read from it.
    write_index_store(spark.read.parquet(str(path)).where("GDD > 1"), str(path))
    assert sorted(r["GDD"] for r in spark.read.parquet(str(path)).collect()) == [2.0, 3.0]
    assert [p.name for p in tmp_path.iterdir()] == ["store"]


def test_a_swap_that_was_cut_short_is_undone(spark, tmp_path):
    path = tmp_path / "store"
    write_index_store(one_cell(spark, "GDD", [1.0]), str(path))
    path.rename(tmp_path / "_store.old-0123")

    def fails(place):
        raise RuntimeError("no disk")

    with pytest.raises(RuntimeError):
        replace_table(spark, str(path), fails)
    assert spark.read.parquet(str(path)).count() == 1
    with pytest.raises(OSError, match="not complete"):
        replace_table(spark, str(path), lambda place: None)
    assert spark.read.parquet(str(path)).count() == 1


def test_fingerprints_follow_files_and_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.range(40).withColumn("k", F.col("id") % 4)
    frame.write.partitionBy("k").parquet(path)
    first = fingerprint(spark.read.parquet(path))
    assert fingerprint(spark.read.parquet(path)) == first
    assert fingerprint(spark.read.parquet(path).select("id")) != first
    frame.where("k = 1").write.partitionBy("k").mode("append").parquet(path)
    assert fingerprint(spark.read.parquet(path)) != first
    assert fingerprint(spark.range(3)) != fingerprint(spark.range(4))


def test_shape_counts_days_without_a_row(spark):
    df = one_cell(spark, "GDD", [1.0, None, 5.0]).withColumn("lon_i", F.when(
        F.col("GDD") == 5, 3).otherwise(0))
    rows = {r["variable"]: r for r in quality.verify_store(df, ["GDD", "SPI"], True).collect()}
    assert quality.store_shape(df) == (3, 1, 2)
    g = rows["GDD"]
    assert (g["n"], g["n_null"], g["days"], g["lats"], g["lons"], g["n_absent"]) == (2, 1, 3, 1, 2, 3)
    assert rows["SPI"]["days"] is None and rows["SPI"]["n_absent"] is None


def test_verify_store_reports_missing_and_extra(spark):
    df = one_cell(spark, "GDD", [1.0, None, 5.0]).withColumn("More", F.lit(2))
    rows = {r["variable"]: r for r in quality.verify_store(df).collect()}
    assert len(rows) == 7 and not rows["SPI"]["present"]
    g = rows["GDD"]
    assert (g["n"], g["n_null"], g["min"], g["max"], g["sample"]) == (2, 1, 1.0, 5.0, 1.0)
    assert rows["More"]["data_type"] == "int"


def test_diagnose(spark):
    ok = spark.createDataFrame([(day(0), 1.0, 2.0, 3.0)],
                               "valid_time date, lat double, lon double, tp double")
    report = quality.diagnose(spark, {"a": ok, "b": None})
    assert [tuple(r) for r in report.collect()] == [("b", "input", "critical", "missing")]
    assert quality.has_critical(report)
    report = quality.diagnose(spark, {
        "a": ok, "b": ok.drop("valid_time"), "c": ok.drop("lat"), "d": ok.limit(0),
        "e": ok.withColumn("valid_time", F.lit(None).cast("timestamp"))})
    found = {(r["dataset"], r["check"]): r["severity"] for r in report.collect()}
    assert found["a", "grid"] == "info" and found["b", "time"] == "critical"
    assert found["c", "grid"] == "warning" and found["d", "rows"] == "warning"
    assert found["d", "grid"] == "warning" and found["e", "missing_time"] == "critical"
    assert found["e", "calendar"] == "warning"
    assert not quality.has_critical(quality.diagnose(spark, {"a": ok}))
    lost = quality.diagnose(spark, {"a": ok.unionByName(
        ok.withColumn("lat", F.lit(None).cast("double")))})
    assert lost.filter("check = 'missing_place' AND detail = '1'").count() == 1


def write(path, text):
    path.write_text(text)
    return str(path)


def test_series_shapes(spark, tmp_path):
    def read(kind, text, **kw):
        path = write(tmp_path / f"{kind}.csv", text)
        return sorted((tuple(r) for r in read_series(spark, path, kind, **kw).collect()),
                      key=str)

    assert read("macro", ",CPIAUCSL,UNRATE\n2010-01-01,217.4,9.8\n") == [
        ("CPIAUCSL", date(2010, 1, 1), 217.4), ("UNRATE", date(2010, 1, 1), 9.8)]
    assert read("risk", "date,GPR\n2010-02-01,80.5\n") == [("GPR", date(2010, 2, 1), 80.5)]
    assert read("annual_supply", "Marketing year 1,US_Production_M_Bu\n2009/10,5\n",
                qualify=True) == [
        ("annual_supply.US_Production_M_Bu", date(2009, 6, 1), 5.0)]
    assert read("quarterly_supply", "Marketing_Year,Time_Period,US_Exports_M_Bu\n"
                "2009/10,Q1 Jun-Aug,1\n2009/10,Q3 Dec-Feb,2\n2009/10,Q4 Mar-May,x\n") == [
        ("US_Exports_M_Bu", date(2009, 12, 1), 2.0),
        ("US_Exports_M_Bu", date(2009, 6, 1), 1.0),
        ("US_Exports_M_Bu", date(2010, 3, 1), None)]
    assert read("market", "Date,^TNX,ZW=F\n2010-01-04,3.8,550.25\n") == [
        ("ZW=F", date(2010, 1, 4), 550.25), ("^TNX", date(2010, 1, 4), 3.8)]
    with pytest.raises(ValueError, match="does not look like"):
        read("commodity", "Date,Gold\n2010-01-01,1\n")
    with pytest.raises(ValueError, match="unknown series kind"):
        read_series(spark, "x", "weather")
    with pytest.raises(FileNotFoundError):
        read_series(spark, str(tmp_path / "none.csv"), "risk")


def test_read_regions_checks_columns(spark, tmp_path):
    path = str(tmp_path / "r")
    spark.createDataFrame([(1, "KS", [(0.0, 1.0)])],
                          "region long, region_abbr string, ring array<struct<x:double,y:double>>"
                          ).write.parquet(path)
    assert read_regions(spark, path).first()["ring"][0]["y"] == 1.0
    spark.range(1).write.parquet(path + "x")
    with pytest.raises(ValueError, match="lacks"):
        read_regions(spark, path + "x")


def test_write_features(spark, tmp_path):
    wide = spark.createDataFrame([(day(0), 1.0)], "Date date, GDD_KS double")
    out = write_features(wide, str(tmp_path), "f", True, True)
    assert out["status"] == "success" and spark.read.parquet(out["output_parquet_path"]).count() == 1
    assert spark.read.option("header", True).csv(out["output_csv_path"]).columns == wide.columns
    for empty in (wide.limit(0), wide.select("Date")):
        out = write_features(empty, str(tmp_path), "e", True, True)
        assert out["output_parquet_path"] is None and out["output_csv_path"] is None


def test_one_format_failing_leaves_the_other(spark, tmp_path):
    nested = spark.createDataFrame([(day(0), [1.0])], "Date date, xs array<double>")
    out = write_features(nested, str(tmp_path), "n", True, True)
    assert out["output_parquet_path"] and out["output_csv_path"] is None
    assert out["error_details"]


@pytest.mark.parametrize("literal_keys", [5000, 0])
def test_missing_partitions(spark, tmp_path, monkeypatch, literal_keys):
    monkeypatch.setattr("croptide.sinks.tables.MAX_LITERAL_KEYS", literal_keys)
    path = str(tmp_path / "p")

    def frame(value, *keys):
        return spark.createDataFrame([(v, y, value) for v, y in keys],
                                     "variable string, year int, x double")

    def stored():
        return {(r["variable"], r["year"]): r["x"] for r in spark.read.parquet(path).collect()}

    write_missing_partitions(frame(1.0, ("t", 2010), ("p", 2010)), path)
    write_missing_partitions(frame(2.0, ("t", 2010), ("t", 2011)), path)
    assert stored() == {("t", 2010): 1.0, ("p", 2010): 1.0, ("t", 2011): 2.0}
    write_missing_partitions(frame(3.0, ("t", 2011)), path, overwrite=True)
    assert stored() == {("t", 2010): 1.0, ("p", 2010): 1.0, ("t", 2011): 3.0}


def test_stages(spark, tmp_path):
    folder, calls = str(tmp_path), []

    def make(n):
        def run():
            calls.append(n)
            return spark.range(n)
        return run

    assert materialize_stage(spark, make(3), "s", folder).count() == 3
    assert materialize_stage(spark, make(4), "s", folder).count() == 3
    assert materialize_stage(spark, make(5), "s", folder, force=True).count() == 5
    assert calls == [3, 5]
    (tmp_path / "stage_s" / "_SUCCESS").unlink()  # an unfinished stage
    assert materialize_stage(spark, make(6), "s", folder).count() == 6
    clear_stages(spark, ["s", "never"], folder)
    assert not (tmp_path / "stage_s").exists()


def fake_session(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default=None: default)
    core = SimpleNamespace(get=lambda key: folder)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(
        master=master, getConf=lambda: core))


def test_stage_root_is_the_shared_folder_of_the_cluster(spark):
    assert session.stage_root(fake_session("yarn", "hdfs://stages/")) == "hdfs://stages"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.stage_root(fake_session("yarn"))
    assert session.stage_root(spark) == session.stage_root(spark)
    assert session.stage_path(spark, "x") != session.stage_path(spark, "x")


def test_pin_small_evaluates_once_or_stays_lazy(spark):
    small = session.pin_small(spark.range(3), 3)
    assert "LocalTableScan" in small._jdf.queryExecution().executedPlan().toString()
    large = session.pin_small(spark.range(4), 3)
    joined = spark.range(10).join(large, "id")
    assert joined.count() == 4
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_stored_keys_are_compared_as_the_column_types_say(spark, tmp_path):
    path = str(tmp_path / "p")

    def frame(x, *names):
        return spark.createDataFrame([(v, 2010, x) for v in names],
                                     "variable string, year int, x double")

    write_missing_partitions(frame(1.0, "10", "a b/c=é", None), path)
    write_missing_partitions(frame(2.0, "010", "10", "a b/c=é", None), path)
    write_missing_partitions(frame(3.0, "010", "10", "1e1"), path, max_literal_keys=1)
    read = spark.read.schema("x double, variable string, year int").parquet(path)
    assert {r["variable"]: r["x"] for r in read.collect()} == {
        "10": 1.0, "a b/c=é": 1.0, None: 1.0, "010": 2.0, "1e1": 3.0}


def test_index_store_is_replaced_whatever_the_session_says(spark, tmp_path):
    path = str(tmp_path / "s")
    two = spark.createDataFrame(
        [(date(y, 5, 1), 0, 0, 0.0, 0.0, 1.0) for y in (2019, 2020)],
        "date date, lat_i int, lon_i int, lat double, lon double, GDD double")
    write_index_store(two, path)
    key = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(key, "dynamic")
    try:
        write_index_store(two.filter("date > '2020-01-01'"), path)
    finally:
        spark.conf.unset(key)
    assert [r["year"] for r in spark.read.parquet(path).collect()] == [2020]
