"""The folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """A folder under ``spark.checkpoint.dir``, which driver and executors share: a new one, or the one called ``name``.

    Only in local mode, where the driver is the executor, may that setting be absent; the folder
    is then a temporary one, removed when Python ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _temporary:
            _temporary.append(tempfile.mkdtemp(prefix="skein-"))
            atexit.register(shutil.rmtree, _temporary[0], ignore_errors=True)
        base = _temporary[0]
    return base.rstrip("/") + f"/skein/{name or uuid.uuid4().hex}"


_temporary: list[str] = []
