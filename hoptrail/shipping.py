"""Getting this package to the Python workers of any cluster."""

from __future__ import annotations

import os
import zipfile

from pyspark.sql import SparkSession

import hoptrail


def ship(spark: SparkSession) -> SparkSession:
    """Hand the package to the executors, once per application. The archive lies
    in the driver's own folder of the application, from where Spark serves it."""
    context = spark.sparkContext
    if getattr(context, "_hoptrail_shipped", False):
        return spark
    root = os.path.dirname(os.path.abspath(hoptrail.__file__))
    path = os.path.join(context._temp_dir, "hoptrail-workers.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for at, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(at, name)
                    archive.write(file, os.path.join("hoptrail", os.path.relpath(file, root)))
    context.addPyFile(path)
    context._hoptrail_shipped = True
    return spark
