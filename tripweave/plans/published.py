"""What each published week was made of, so that only changed weeks are published again."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from tripweave.sources.folders import data_files, read_text, remove, write_text

#: Beside the data of a week. Spark's readers skip it, and replacing the week removes it.
MANIFEST = "_published.json"
LOOKS_AT_ONCE = 16

Files = Mapping[str, frozenset[str]]


def _each(look: Callable, names: Iterable[str]) -> dict:
    """Small look-ups in a file system, side by side."""
    names = sorted(names)
    with ThreadPoolExecutor(max_workers=LOOKS_AT_ONCE) as pool:
        return dict(zip(names, pool.map(look, names), strict=True))


def files_of_days(spark: SparkSession, daily_dir: str, days: Iterable[str]) -> Files:
    """The names of the data files of stored days. A day that is stored again gets new names."""
    root = daily_dir.rstrip("/")
    return _each(lambda d: data_files(spark, f"{root}/pickup_date={d}"), days)


def _folder(weekly_dir: str, week: str) -> str:
    return f"{weekly_dir.rstrip('/')}/week_name={week}"


def _manifest(daily_dir: str, days: Files, files: frozenset[str]) -> dict:
    return {
        "daily_dir": daily_dir.rstrip("/"),
        "days": {d: sorted(names) for d, names in days.items()},
        "files": sorted(files),
    }


def record(spark: SparkSession, daily_dir: str, weekly_dir: str, weeks: Mapping[str, Files]) -> None:
    """Note the days and files that went into weeks which have just been written."""

    def note(week: str) -> None:
        folder = _folder(weekly_dir, week)
        made_of = _manifest(daily_dir, weeks[week], data_files(spark, folder))
        write_text(spark, f"{folder}/{MANIFEST}", json.dumps(made_of, sort_keys=True))

    _each(note, weeks)


def changed_weeks(
    spark: SparkSession, daily_dir: str, weekly_dir: str, weeks: Mapping[str, Files]
) -> set[str]:
    """The weeks whose days or files are not those of their manifest.

    A day that is new, stored again or gone changes its week, and so does a week folder that
    is missing, has lost or gained a file, has no manifest or comes from another store.
    """

    def changed(week: str) -> bool:
        folder = _folder(weekly_dir, week)
        text = read_text(spark, f"{folder}/{MANIFEST}")
        if text is None:
            return True
        now = _manifest(daily_dir, weeks[week], data_files(spark, folder))
        try:
            return json.loads(text) != now
        except ValueError:  # cut short while it was written
            return True

    return {week for week, is_changed in _each(changed, weeks).items() if is_changed}


def remove_weeks(spark: SparkSession, weekly_dir: str, weeks: Iterable[str]) -> None:
    for week in weeks:
        remove(spark, _folder(weekly_dir, week))
