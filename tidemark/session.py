"""Session defaults of the engine."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: What results depend on; everything else is left to the cluster.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    # the last of equal JSON keys counts, as with the stored text's usual readers
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Sets what results depend on in a session that the caller made."""
    for k, v in REQUIRED.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def session(app: str = "tidemark", **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(app).config("spark.sql.adaptive.enabled", "true")
    for k, v in (REQUIRED | conf).items():
        b = b.config(k, v)
    return configure(b.getOrCreate())
