"""The session every job expects: UTC, adaptive execution, ANSI casts (bad text is handled by try_ functions)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(name: str = "drayage", master: str | None = None, **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(name)
    if master:
        b = b.master(master)
    defaults = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.ansi.enabled": "true"}
    return b.config(map=defaults | {k.replace("__", "."): v for k, v in conf.items()}).getOrCreate()
