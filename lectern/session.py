"""What a session needs before Python runs on its executors."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def reachable(spark: SparkSession) -> None:
    """Python workers find this package, wherever the driver was started.

    On a cluster without a shared installation ship the package with ``--py-files`` instead."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = ":".join([ROOT, *paths])
