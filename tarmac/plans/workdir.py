"""Where derived tables of a session are kept."""

from __future__ import annotations

import tempfile
import threading

from pyspark.sql import SparkSession

_lock = threading.RLock()
_local: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """A folder every executor can reach, private to this application.

    It lies in the folder the cluster names in `spark.checkpoint.dir`. Only a local
    session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    app = context.applicationId
    if shared:
        return f"{shared.rstrip('/')}/tarmac-{app}"
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    with _lock:
        if app not in _local:
            _local[app] = tempfile.mkdtemp(prefix="tarmac-")
        return _local[app]
