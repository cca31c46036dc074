"""Raw files of unknown schema versions."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import as_dicts
from tripweave.contracts import DataValidationError
from tripweave.sources import footers
from tripweave.sources.fleets import YELLOW, SourceSpec


def write(spark, folder, name, *columns, rows=2):
    spark.range(rows).selectExpr(*columns).coalesce(1).write.parquet(str(folder / name))


def files_of(spark, folder):
    return SourceSpec("x", paths=(f"{folder}/*",))._files(spark)


def test_whole_then_floating_numbers_load_without_versions(spark, tmp_path):
    write(spark, tmp_path, "y_2024-01", "id AS passenger_count", "id AS VendorID", rows=3)
    write(spark, tmp_path, "y_2024-02", "1.5D AS passenger_count", "CAST(id AS INT) AS VendorID")
    spec = SourceSpec("Yellow", paths=(f"{tmp_path}/*",), widen=True)
    trips = spec.normalize(spec.read(spark))
    assert dict(trips.dtypes)["passenger_count"] == "double"
    assert sorted(r["passenger_count"] for r in trips.collect()) == [0.0, 1.0, 1.5, 1.5, 2.0]
    assert dict(spec.read(spark).dtypes)["VendorID"] == "bigint"


def test_types_that_alternate_share_a_group(spark, tmp_path):
    for k in range(12):
        kind = ("BIGINT", "DOUBLE", "DECIMAL(10,2)")[k % 3]
        more = ["id AS extra"] if k == 7 else []
        write(spark, tmp_path, f"f{k:02d}", f"CAST(id + {k} AS {kind}) AS n", "id AS at", *more)
    groups = footers.group_files(spark, files_of(spark, tmp_path))
    assert sorted(len(g.paths) for g in groups) == [4, 4, 4]
    rows = footers.read_groups(spark, groups)
    assert dict(rows.dtypes) == {"n": "double", "at": "bigint", "extra": "bigint"}
    assert rows.agg(F.sum("n"), F.count("extra"), F.count("*")).first() == (144.0, 2, 24)


def test_few_footer_jobs_where_types_change_once(spark, tmp_path, monkeypatch):
    for k in range(32):
        write(spark, tmp_path, f"f{k:02d}", f"CAST(id AS {'BIGINT' if k < 11 else 'DOUBLE'}) AS n")
    asked, merged = [], footers.merged_schema
    monkeypatch.setattr(footers, "merged_schema", lambda s, p: asked.append(p) or merged(s, p))
    groups = footers.group_files(spark, files_of(spark, tmp_path))
    assert [len(g.paths) for g in groups] == [11, 21]
    assert len(asked) <= 2 * 5 + 1


def test_filters_reach_the_files_of_every_group(spark, tmp_path, capsys):
    stamp = "TIMESTAMP_NTZ'2024-01-01 08:00:00' AS tpep_pickup_datetime"
    write(spark, tmp_path, "a", "id AS n", stamp)
    write(spark, tmp_path, "b", "1.5D AS n", stamp)
    rows = footers.read_groups(spark, footers.group_files(spark, files_of(spark, tmp_path)))
    YELLOW.normalize(rows).filter("pickup_datetime >= TIMESTAMP_NTZ'2024-01-02'").explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("GreaterThanOrEqual(tpep_pickup_datetime,2024-01-02") == 2


def test_types_that_would_be_a_guess_are_errors(spark, tmp_path):
    write(spark, tmp_path, "a", "id AS n")
    write(spark, tmp_path, "b", "'7' AS n")
    groups = footers.group_files(spark, files_of(spark, tmp_path))
    with pytest.raises(DataValidationError, match="n is bigint and string"):
        footers.read_groups(spark, groups)


def test_no_files_is_no_group(spark):
    assert footers.group_files(spark, []) == []


def test_spellings_of_one_column_stay_one(spark, tmp_path):
    write(spark, tmp_path, "a", "1.5D AS airport_fee", "id AS n")
    write(spark, tmp_path, "b", "2.5D AS Airport_fee", "1.0D AS n")
    rows = footers.read_groups(spark, footers.group_files(spark, files_of(spark, tmp_path)))
    assert rows.columns == ["airport_fee", "n"]
    assert sorted(r["airport_fee"] for r in as_dicts(rows)) == [1.5, 1.5, 2.5, 2.5]


@pytest.mark.parametrize(
    ("a", "b", "kind"),
    [
        ("int", "bigint", "bigint"),
        ("bigint", "double", "double"),
        ("int", "float", "double"),
        ("decimal(10,2)", "int", "decimal(12,2)"),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
        ("decimal(38,2)", "decimal(38,9)", "double"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("void", "string", "string"),
        ("timestamp", "timestamp_ntz", None),
        ("string", "int", None),
        ("boolean", "int", None),
        ("struct<a:int>", "struct<a:bigint>", None),
    ],
)
def test_wider_types(spark, a, b, kind):
    first, second = (
        T.NullType() if t == "void" else spark.createDataFrame([], f"c {t}").schema["c"].dataType
        for t in (a, b)
    )
    found = footers.wider(first, second)
    assert found == footers.wider(second, first)
    assert (found and found.simpleString()) == kind
