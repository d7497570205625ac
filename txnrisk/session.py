"""Session construction and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def build_session(app: str = "txnrisk", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are designed for.

    AQE picks join strategies and coalesces partitions at run time, and splits
    skewed shuffle partitions of a join; UTC keeps dates and hours
    reproducible. On a cluster set ``spark.sql.shuffle.partitions`` so that
    one shuffle partition is some 100-200 MB.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the one the cluster names in ``spark.checkpoint.dir``; only where
    that is unset (a local test) a temporary folder takes its place.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="txnrisk-")


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/txnrisk/{label}-{uuid.uuid4().hex}"


def side_by_side(spark: SparkSession, steps: Sequence[Callable]) -> list:
    """Results of steps that do not depend on each other, whose Spark jobs run at the same time.

    All have ended when this returns or raises, with what the first of them raised.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [done.result() for done in running]
