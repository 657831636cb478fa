"""Session settings the library is tuned for."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "tarmac", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC dates and adaptive execution; `conf` keys use `__` for `.`.

    Joins with the airport and airline dimensions carry no broadcast hint: Spark
    broadcasts them while they stay under `autoBroadcastJoinThreshold` and falls
    back to a shuffled join (with adaptive skew splitting) beyond it.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Settings that hold inside the block only; a stream that is started there keeps them."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
