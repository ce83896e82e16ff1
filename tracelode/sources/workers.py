"""What Python workers need to run this package's functions."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def importable(spark: SparkSession) -> None:
    """Puts this package's folder on the path of Python workers that are yet to start. It helps where workers run on
    this machine; on a cluster the package is installed or shipped with ``--py-files``, and the entry does no harm."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
