"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Strict parsing raises on text that is no number or date; without ANSI it would read NULL.
    "spark.sql.ansi.enabled": "true",
    # Staging is one projection over about 60 text columns. Generated as a single
    # whole-stage method it passes the size HotSpot compiles, and runs interpreted;
    # with this limit Spark splits such a projection into methods that are compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
