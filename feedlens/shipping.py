"""This package on the executors, for the tasks that run its functions."""

from __future__ import annotations

import hashlib
import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import feedlens
from feedlens.session import shared_folder

#: Applications that have the package.
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package's sources to the application, through the shared folder, once.

    Workers import it from there, so it need not be installed on the cluster's machines.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(feedlens.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, f"{root.name}/{source.relative_to(root)}")
    name = f"{root.name}-{hashlib.sha256(packed.getvalue()).hexdigest()[:16]}.zip"
    path = f"{shared_folder(spark)}/{name}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(packed.getvalue()))
    finally:
        out.close()
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
