"""Work folders, written intermediate tables and shipping of this package to executors."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the operators understand it: space, tab, line feed to carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_local: dict[str, str] = {}
_shipped: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder named in `spark.checkpoint.dir`; a temporary one only in a local session without it."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="tarmac-llm-")
    return _local[app]


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one call; every executor can reach it."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write and reread: cuts the lineage and survives lost executors."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = Path(__file__).resolve().parent
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tarmac-ship-")), "tarmac_llm.zip")
    with zipfile.ZipFile(archive, "w") as out:
        out.write(here.parent / "__init__.py", "tarmac/__init__.py")
        for path in sorted(here.glob("*.py")):
            out.write(path, f"tarmac/llm/{path.name}")
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hash_sample(rows: DataFrame, most: int, *keys) -> DataFrame:
    """About `most` of the rows, or all if there are no more, by a limit on the hash of their keys.

    The limit follows from the number of rows, so that nothing is sorted or gathered, and the
    sample is the same on every run.
    """
    share = min(1.0, most / max(1, rows.count()))
    return rows.filter(F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) < int(share * (1 << 30)))


def text_rows(docs: DataFrame, *others: str) -> DataFrame:
    """doc_id, text (null as empty) and further columns; what else a table holds is left out."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *others)


def release_memory() -> None:
    """Hand what a Python worker no longer uses back to the system, as idle workers outlive their stage."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(work: Callable) -> Callable:
    """A function over batches that releases memory when its task ends."""
    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            release_memory()

    return run
