"""Lines of JSON on a stream, broken ones between."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import TRIP_DDL, trip
from tripweave.streaming import json_lines
from tripweave.streaming.windows import all_windows, window_counts, write_windows

DDL = "a bigint, at timestamp_ntz"
CASES = {
    '{"a":1,"at":"2024-01-01T08:00:00.123456"}': "none",
    '{"at":"2024-01-01T08:00:00","z":{"b":[1]}}': "none",
    ' {"a":null,"at":"2024-01-01T08:00:00"} ': "none",
    '{"a":1': "broken",
    "nope": "broken",
    "null": "broken",
    '"x"': "broken",
    "[]": "broken",
    '[{"a":1,"at":"2024-01-01T08:00:00"}]': "broken",
    '{"a":1,"at":"2024-01-01T08:00:00"} junk': "broken",
    '{"a":1,"at":"2024-01-01T08:00:00"}{"a":2}': "broken",
    '{"a":1,"at":"2024-01-01T08:00:00"},{"a":2}': "broken",
    '{"a":1,"a":2,"at":"2024-01-01T08:00:00"}': "broken",
    '{"a":"x","at":"2024-01-01T08:00:00"}': "broken",
    '{"a":1.5,"at":"2024-01-01T08:00:00"}': "broken",
    '{"a":1,"at":"soon"}': "broken",
    "{}": "incomplete",
    '{"a":7,"at":null}': "incomplete",
}


def schema_of(spark, ddl):
    return spark.createDataFrame([], ddl).schema


def test_what_is_wrong_with_a_line(spark):
    lines = spark.createDataFrame([(t,) for t in [*CASES, "", " \t", None]], "value string")
    rows = json_lines.parse_lines(lines, schema_of(spark, DDL), ["at"]).collect()
    assert len(rows) == len(CASES)
    wrong = {r["line"]: r["problem"] for r in rows if r["line"] is not None}
    assert wrong == {t: p for t, p in CASES.items() if p != "none"}
    assert all(r["a"] is None and r["at"] is None for r in rows if r["line"] is not None)
    sound = [r for r in rows if r["line"] is None]
    assert sorted(str(r["a"]) for r in sound) == ["1", "None", "None"]
    assert {r["at"].microsecond for r in sound} == {0, 123456}


def test_a_very_long_line_is_kept_whole(spark):
    lines = spark.createDataFrame([("{" + "x" * 300_000,)], "value string")
    row = json_lines.parse_lines(lines, schema_of(spark, DDL)).first()
    assert (row["problem"], len(row["line"])) == ("broken", 300_001)


@pytest.fixture
def places(tmp_path):
    (tmp_path / "in").mkdir()
    return [str(tmp_path / n) for n in ("in", "landed", "s1", "windows", "s2")]


def test_windows_are_those_of_the_sound_lines(spark, make_trips, tmp_path, places):
    source, landed, landing_state, out, window_state = places
    schema = schema_of(spark, TRIP_DDL)

    def arrive(name, minutes, junk):
        trips = make_trips([trip(pickup=f"2024-01-01 08:{m:02d}:00", total=m + 0.25) for m in minutes])
        as_json = trips.select(F.to_json(F.struct("*"), json_lines.TIMES).alias("v"))
        text = [r["v"] for r in as_json.collect()]
        mixed = [x for pair in zip(text, junk, strict=False) for x in pair] + text[len(junk) :]
        (tmp_path / "in" / name).write_text("\n".join(mixed) + "\n\n")
        return trips

    def run():
        lines = json_lines.stream_lines(spark, source)
        parsed = json_lines.parse_lines(lines, schema, ["pickup_datetime"])
        json_lines.land_lines(parsed, landed, landing_state)
        counts = window_counts(json_lines.stream_sound(spark, landed, schema))
        assert write_windows(counts, out, window_state) == 0
        apart = json_lines.set_apart(spark, landed, schema).groupBy("problem").count()
        found = sorted(map(tuple, all_windows(spark, out, window_state).collect()))
        return found, {r["problem"]: r["count"] for r in apart.collect()}

    first = arrive("one.json", range(0, 30), ['{"taxi_type":"Green"', "{}", "?"])
    expected = sorted(map(tuple, window_counts(first).collect()))
    assert run() == (expected, {"broken": 2, "incomplete": 1})
    second = arrive("two.json", range(25, 60), ["??"])
    expected = sorted(map(tuple, window_counts(first.unionByName(second)).collect()))
    assert run() == (expected, {"broken": 3, "incomplete": 1})
    assert run() == (expected, {"broken": 3, "incomplete": 1})
