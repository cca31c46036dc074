"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def build_session(app_name: str = "tripweave", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the plans rely on; ``conf`` keys override them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tripweave-")


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new path below the folder named by ``spark.checkpoint.dir``.

    The folder must be visible to every executor. Only a local master may go without
    the setting; it then gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_folder()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def at_once(spark: SparkSession, calls: Sequence[Callable]) -> list:
    """Results of independent small Spark actions, submitted side by side.

    For a handful of actions over small tables, where the time goes into waiting for one
    job after the other. The first error is raised.
    """
    if not calls:
        return []
    with ThreadPoolExecutor(max_workers=len(calls)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]
        return [future.result() for future in started]
