"""Makes this package importable in Spark's Python workers."""

from __future__ import annotations

import os
import zipfile

from pyspark.sql import SparkSession

import countwise
from countwise.session import scratch_path

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once per application.

    Not needed, and not done, where PYTHONPATH names its folder already; a
    cluster job may as well pass the package with ``--py-files``.
    """
    folder = os.path.dirname(os.path.abspath(countwise.__file__))
    root = os.path.dirname(folder)
    context = spark.sparkContext
    on_path = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if context.applicationId in _SHIPPED or root in on_path:
        return
    jvm = context._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "python") + "/countwise.zip")
    stream = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    stream.write(bytearray(_zipped(folder, root)))
    stream.close()
    context.addPyFile(path.toString())
    _SHIPPED.add(context.applicationId)


def _zipped(folder: str, root: str) -> bytes:
    import io

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for at, _, names in os.walk(folder):
            for name in sorted(names):
                if name.endswith(".py"):
                    z.write(os.path.join(at, name), os.path.relpath(os.path.join(at, name), root))
    return out.getvalue()
