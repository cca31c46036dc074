from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import as_dicts, at, trip
from tripweave.contracts import DataValidationError, SchemaError
from tripweave.operators import sinks
from tripweave.operators.days import trips_on
from tripweave.sources import fleets, metric_files, stores
from tripweave.sources.metric_files import read_metric_csv

GREEN_DDL = (
    "VendorID int, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, "
    "passenger_count double, trip_distance double, total_amount double, ehail_fee double, "
    "Airport_fee double"
)
YELLOW_DDL = (
    "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count bigint, trip_distance double, total_amount double, airport_fee double"
)


@pytest.fixture
def raw(spark):
    p, d = at("2024-01-01 23:59:59.999999"), at("2024-01-02 00:10:00")
    green = spark.createDataFrame([(1, p, d, 2.0, 1.5, 9.0, 0.5, 1.0)] * 2, GREEN_DDL)
    yellow = spark.createDataFrame([(2**40, p, d, None, 2.5, 11.0, 1.0)], YELLOW_DDL)
    return green, yellow


def test_combined_columns_are_common_sorted_and_case_sensitive(raw):
    combined = fleets.combine([fleets.GREEN.normalize(raw[0]), fleets.YELLOW.normalize(raw[1])])
    assert combined.columns == [
        "VendorID",
        "dropoff_datetime",
        "passenger_count",
        "pickup_datetime",
        "taxi_type",
        "total_amount",
        "trip_distance",
    ]


def test_combining_widens_numbers_and_keeps_duplicates(raw):
    combined = fleets.combine([fleets.GREEN.normalize(raw[0]), fleets.YELLOW.normalize(raw[1])])
    types = dict(combined.dtypes)
    assert (types["VendorID"], types["passenger_count"]) == ("bigint", "double")
    assert sorted(r["taxi_type"] for r in combined.collect()) == ["Green", "Green", "Yellow"]


def test_renames_match_case_and_skip_absent_columns(spark):
    df = spark.createDataFrame([(at("2024-01-01"),)], "LPEP_pickup_datetime timestamp_ntz")
    assert fleets.GREEN.normalize(df).columns == ["LPEP_pickup_datetime", "taxi_type"]


def test_pickup_only_variant(raw):
    green = fleets.pickup_only(fleets.GREEN).normalize(raw[0])
    assert "pickup_datetime" in green.columns and "lpep_dropoff_datetime" in green.columns
    assert green.first()["taxi_type"] == "green"


def test_load_trips_pushes_a_day_filter_into_both_scans(spark, raw, tmp_path, capsys):
    paths = [str(tmp_path / n) for n in ("green", "yellow")]
    for df, path in zip(raw, paths, strict=True):
        df.write.parquet(path)
    specs = [
        replace(spec, paths=(path,))
        for spec, path in zip((fleets.GREEN, fleets.YELLOW), paths, strict=True)
    ]
    trips = fleets.load_trips(spark, specs)
    found = trips_on(trips, "2024-01-01")
    assert found.count() == 3
    found.explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(lpep_pickup_datetime,2024-01-01" in plan
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2024-01-01" in plan


def test_one_source_may_have_several_schemas(spark):
    """Months whose types differ are specs of their own with the same tag."""
    ddl = "lpep_pickup_datetime timestamp_ntz, passenger_count "
    old = spark.createDataFrame([(at("2024-01-01"), 2)], ddl + "bigint")
    new = spark.createDataFrame([(at("2024-02-01"), 1.0)], ddl + "double")
    rows = fleets.combine([fleets.GREEN.normalize(old), fleets.GREEN.normalize(new)])
    assert dict(rows.dtypes)["passenger_count"] == "double"
    assert {(r["taxi_type"], r["passenger_count"]) for r in rows.collect()} == {
        ("Green", 2.0),
        ("Green", 1.0),
    }


def test_days_from_files_of_different_types_fit_together(spark, tmp_path):
    store = str(tmp_path / "daily")
    ddl = "tpep_pickup_datetime timestamp_ntz, VendorID {}, passenger_count {}"
    files = (("01", (1, 2), ("int", "bigint")), ("02", (3, None), ("bigint", "double")))
    for day, row, kinds in files:
        raw = spark.createDataFrame([(at(f"2024-01-{day}"), *row)], ddl.format(*kinds))
        sinks.save_days(fleets.YELLOW.normalize(raw), store)
    rows = stores.load_days(spark, store).orderBy("pickup_date").collect()
    assert [(r["VendorID"], r["passenger_count"]) for r in rows] == [(1, 2.0), (3, None)]


def test_zones_move_local_times_across_daylight_saving(spark):
    df = spark.createDataFrame(
        [(at("2024-01-15 12:00:00"),), (at("2024-07-15 12:00:00"),)],
        "pickup_datetime timestamp_ntz",
    )
    spec = fleets.SourceSpec("east", time_zone="America/New_York")
    hours = [r["pickup_datetime"].hour for r in spec.normalize(df).collect()]
    assert hours == [17, 16]


def test_versions_pick_a_schema_by_file_date(spark, tmp_path):
    old = T.StructType([T.StructField("a", T.LongType())])
    new = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])
    versions = [fleets.SchemaVersion(old, "2024-01-01"), fleets.SchemaVersion(new)]
    assert fleets.schema_for(versions, "2023-12-31") is old
    assert fleets.schema_for(versions, "2024-01-01") is new
    files = {str(tmp_path / "x"): "2023-05-01", str(tmp_path / "y"): "2024-05-01"}
    spark.createDataFrame([(1,)], old).write.parquet(str(tmp_path / "x"))
    spark.createDataFrame([(2, 0.5)], new).write.parquet(str(tmp_path / "y"))
    rows = as_dicts(fleets.read_versions(spark, files, versions).orderBy("a"))
    assert rows == [{"a": 1, "b": None}, {"a": 2, "b": 0.5}]


def test_raw_files_keep_every_column_or_fail(spark, tmp_path):
    folder = str(tmp_path / "raw" / "green_2024-0")
    spark.range(2).selectExpr("id AS passenger_count").write.parquet(f"{folder}1")
    later = spark.range(3).selectExpr("id AS passenger_count", "1.5D AS congestion_surcharge")
    later.write.parquet(f"{folder}2")
    spec = fleets.SourceSpec("Green", paths=(f"{folder}*",))
    df = spec.normalize(spec.read(spark))
    assert dict(df.dtypes)["passenger_count"] == "double"
    assert df.agg(F.count("passenger_count"), F.count("congestion_surcharge")).first() == (5, 3)
    other = spark.range(1).selectExpr("CAST(id AS DOUBLE) AS passenger_count")
    other.write.parquet(f"{folder}3")
    with pytest.raises(DataValidationError, match="disagree on a type"):
        spec.read(spark)
    versions = (
        fleets.SchemaVersion(later.schema, "2024-03-01"),
        fleets.SchemaVersion(other.schema),
    )
    dated = replace(spec, versions=versions)
    assert dated.normalize(dated.read(spark)).agg(F.count("passenger_count")).first()[0] == 6
    with pytest.raises(DataValidationError, match="no date"):
        replace(dated, file_day="never").read(spark)


def test_no_stored_days_is_none(spark, tmp_path):
    assert stores.load_days(spark, str(tmp_path / "absent")) is None
    (tmp_path / "empty").mkdir()
    assert stores.load_days(spark, str(tmp_path / "empty")) is None


def test_missing_and_empty_week_tables_are_errors(spark, make_trips, tmp_path):
    with pytest.raises(DataValidationError):
        stores.load_week_table(spark, "week_1_nowhere_2024")
    empty = make_trips([trip()]).filter("false")
    empty.write.mode("overwrite").saveAsTable("week_4_empty_2024")
    with pytest.raises(DataValidationError, match="is empty"):
        stores.load_week_table(spark, "week_4_empty_2024")
    with pytest.raises(DataValidationError):
        stores.load_week(spark, str(tmp_path / "absent"), "week_1_may_2024")


def test_days_may_differ_in_columns(spark, make_trips, tmp_path):
    store = str(tmp_path / "daily")
    sinks.save_days(make_trips([trip()]), store)
    later = make_trips([trip(pickup="2024-01-02 08:00:00")])
    sinks.save_days(later.withColumn("tip_amount", F.lit(1.5)), store)
    rows = stores.load_days(spark, store).orderBy("pickup_date").collect()
    assert [r["tip_amount"] for r in rows] == [None, 1.5]


def test_reading_a_store_opens_no_footer(spark, make_trips, tmp_path):
    store, tracker = str(tmp_path / "daily"), spark.sparkContext.statusTracker()
    sinks.save_days(make_trips([trip()]), store)
    later = make_trips([trip(pickup="2024-01-02 08:00:00")])
    sinks.save_days(later.withColumn("tip_amount", F.lit(1.5)), store)
    sinks.save_days(later.withColumn("extra", F.lit(2)).limit(0), store)
    spark.sparkContext.setJobGroup("open", "open")
    days = stores.load_days(spark, store)
    assert set(days.columns) >= {"tip_amount", "extra"}
    assert len(tracker.getJobIdsForGroup("open")) == 0
    spark.sparkContext.setJobGroup("read", "read")
    rows = days.orderBy("pickup_date").collect()
    assert [(r["tip_amount"], r["extra"]) for r in rows] == [(None, None), (1.5, None)]
    assert [str(r["pickup_date"]) for r in rows] == ["2024-01-01", "2024-01-02"]
    spark.sparkContext.setJobGroup("", "")
    assert len(list((tmp_path / "daily" / "_schemas").glob("*.json"))) == 3
    sinks.save_days(make_trips([trip()]), store)
    assert len(list((tmp_path / "daily" / "_schemas").glob("*.json"))) == 3


def test_a_store_without_notes_keeps_its_columns(spark, make_trips, tmp_path):
    store = str(tmp_path / "daily")
    old = make_trips([trip()]).withColumns({"tip_amount": F.lit(1.5), "pickup_date": F.lit("2024-01-01")})
    old.write.partitionBy("pickup_date").parquet(store)
    assert stores.load_days(spark, store).first()["tip_amount"] == 1.5
    sinks.save_days(make_trips([trip(pickup="2024-01-02 08:00:00")]), store)
    rows = stores.load_days(spark, store).orderBy("pickup_date").collect()
    assert [r["tip_amount"] for r in rows] == [1.5, None]


def test_days_that_changed_a_type_are_read_by_their_footers(spark, make_trips, tmp_path):
    store, trips = str(tmp_path / "daily"), make_trips([trip()])
    sinks.save_days(trips.withColumn("extra", F.lit(1)), store)
    sinks.save_days(trips.withColumn("extra", F.lit("one")), store)
    assert stores.load_days(spark, store).first()["extra"] == "one"


def test_no_stored_rows_is_none(spark, make_trips, tmp_path):
    store = str(tmp_path / "daily")
    sinks.save_days(make_trips([trip()]).limit(0), store)
    assert stores.load_days(spark, store) is None
    sinks.save_days(make_trips([trip()]), store)
    assert stores.load_days(spark, store, ["2024-01-05"]) is None
    assert stores.load_days(spark, store, ["2024-01-01"]).count() == 1


def test_stored_days_are_listed_with_their_week(spark, make_trips, tmp_path):
    store = str(tmp_path / "daily")
    stamps = ["2024-02-29 23:00:00", "2024-03-01 00:00:00", "2024-03-01 09:00:00"]
    sinks.save_days(make_trips([trip(pickup=s) for s in stamps]), store)
    listed = stores.stored_days(spark, store)
    assert {(str(r["pickup_date"]), r["week_name"]) for r in listed.collect()} == {
        ("2024-02-29", "week_5_february_2024"),
        ("2024-03-01", "week_1_march_2024"),
    }
    assert listed.count() == 2
    assert stores.first_week(listed).first()["week_name"] == "week_5_february_2024"
    assert stores.first_week(listed.filter("false")).first()["week_name"] == "weekly_taxi_data"


def test_jdbc_scan_is_split_by_pickup_time_when_days_are_known():
    whole = stores.jdbc_options("jdbc:x:y", "week_1_may_2024")
    split = stores.jdbc_options("jdbc:x:y", "week_1_may_2024", ("2024-05-01", "2024-05-07"), 4)
    assert "partitionColumn" not in whole and whole["dbtable"] == "week_1_may_2024"
    assert (split["partitionColumn"], split["numPartitions"]) == ("pickup_datetime", "4")


def write_text(path, text):
    path.write_text(text)
    return str(path)


def test_metric_csv_takes_old_names_and_any_flag_case(spark, tmp_path):
    path = write_text(
        tmp_path / "a.csv",
        "pickup_date,taxi_type,trips_per_day,is_anomaly\n2024-01-02,Green,5,True\n"
        "2024-01-01,Green,7,false\n2024-01-03,Green,8,\n",
    )
    df = metric_files.read_metric_csv(spark, path, ["date", "total_trips"])
    assert df.dtypes == [
        ("date", "string"),
        ("taxi_type", "string"),
        ("total_trips", "bigint"),
        ("is_anomaly", "boolean"),
    ]
    assert [r["is_anomaly"] for r in df.orderBy("date").collect()] == [False, True, None]


def test_revenue_alias_only_without_a_current_name(spark, tmp_path):
    old = write_text(tmp_path / "old.csv", "date,revenue_per_day\n2024-01-01,1.5\n")
    both = write_text(
        tmp_path / "both.csv", "date,revenue_per_day,total_revenue_per_day\n2024-01-01,1.5,2.5\n"
    )
    assert metric_files.read_metric_csv(spark, old, ["date"]).columns == ["date", "total_revenue"]
    assert "total_revenue" not in metric_files.read_metric_csv(spark, both, ["date"]).columns
    with pytest.raises(SchemaError, match="total_revenue_per_day"):
        metric_files.read_metric_csv(spark, old, ["date", "total_revenue_per_day"])


def test_one_bad_date_keeps_the_whole_column_as_text(spark, tmp_path):
    good = write_text(tmp_path / "g.csv", "date\n2024-01-01 05:00:00\n2024-1-2\n")
    bad = write_text(tmp_path / "b.csv", "date\n2024-01-01 05:00:00\nsoon\n")

    def read(path):
        return [r["date"] for r in metric_files.read_metric_csv(spark, path, []).collect()]

    assert read(good) == ["2024-01-01", "2024-01-02"]
    assert read(bad) == ["2024-01-01 05:00:00", "soon"]


def test_metric_folder_reads_all_parts(spark, tmp_path):
    folder = tmp_path / "m.csv"
    folder.mkdir()
    for i in (1, 2, 3):
        write_text(folder / f"part-0000{i}.csv", f"date,total_trips\n2024-01-0{i},{i}\n")
    assert metric_files.read_metric_csv(spark, str(folder), ["date"]).count() == 3


def write_parts(folder, **files):
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


TRIP_COUNTS = ("date", "taxi_type", "total_trips")


def test_whole_decimals_are_counts(spark, tmp_path):
    text = "date,taxi_type,total_trips\n2024-01-01,Green,12.0\n2024-01-02,Green,\n"
    path = write_parts(tmp_path / "a", one=text)
    df = read_metric_csv(spark, path, TRIP_COUNTS)
    assert dict(df.dtypes)["total_trips"] == "bigint"
    assert [r["total_trips"] for r in df.orderBy("date").collect()] == [12, None]


@pytest.mark.parametrize("value", ["abc", "12.5", "1e30"])
def test_values_that_do_not_fit_are_errors(spark, tmp_path, value):
    text = f"date,taxi_type,total_trips\n2024-01-01,Green,{value}\n2024-01-02,Green,1\n"
    path = write_parts(tmp_path / "a", one=text)
    with pytest.raises(DataValidationError, match="1 values of total_trips are no bigint"):
        read_metric_csv(spark, path, TRIP_COUNTS)


def test_parts_with_another_header_are_errors(spark, tmp_path):
    path = write_parts(
        tmp_path / "a",
        one="date,taxi_type,total_trips\n2024-01-01,Green,1\n",
        two="taxi_type,date,total_trips\nGreen,2024-01-02,2\n",
    )
    with pytest.raises(DataValidationError, match="differ in their columns"):
        read_metric_csv(spark, path, TRIP_COUNTS)


def test_missing_metric_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        metric_files.read_week_metric(spark, str(tmp_path), "week_1_may_2024", "trips_per_day")


def test_week_tables_are_listed(spark, make_trips):
    make_trips([trip()]).write.mode("overwrite").saveAsTable("week_3_listed_2024")
    names = [r["week_name"] for r in stores.list_week_tables(spark).collect()]
    assert "week_3_listed_2024" in names
    assert stores.list_weeks(make_trips([trip(), trip(pickup=None)])).count() == 1
