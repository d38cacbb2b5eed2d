"""Makes this package importable in Python workers."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the workers, once a session, unless PYTHONPATH has it."""
    root = os.path.dirname(os.path.dirname(os.path.realpath(__file__)))
    on_path = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    app = spark.sparkContext.applicationId
    if root in on_path or app in _shipped:
        return
    folder = os.path.realpath(tempfile.mkdtemp(prefix="landsurvey-ship-"))
    package = os.path.basename(os.path.dirname(os.path.realpath(__file__)))
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, package), "zip", root, package))
    _shipped.add(app)
