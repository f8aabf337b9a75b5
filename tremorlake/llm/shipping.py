"""Prepares a session for operators that run Python in tasks."""

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

#: Bytes of rows that reach a Python worker at once, unless the session was started with a bound of its own. Texts
#: are held several times over on their way, so large batches cost an executor much memory and gain nothing.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"

_DONE: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Makes this package importable in Python workers, wherever the driver found it, and bounds their batches."""
    context = spark.sparkContext
    if not context.getConf().contains(BATCH_SETTING):
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    if context.applicationId not in _DONE:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="tremorlake-"), "tremorlake_source.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
            for folder, _, names in sorted(os.walk(package)):
                for name in sorted(n for n in names if n.endswith(".py")):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.relpath(file, os.path.dirname(package)))
        context.addPyFile(path)
        _DONE.add(context.applicationId)
    return spark
