"""Session settings that the plans of this package need to run at full speed."""

from __future__ import annotations

from pyspark.sql import SparkSession

_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
# Fixed value: the JVM leaves methods above this many bytecodes uncompiled.
_JIT_LIMIT = 8000


def tune(spark: SparkSession) -> SparkSession:
    """Keep generated code small enough for the JVM to compile it.

    Cleaning and encoding a row in one generated method is long enough to stay interpreted,
    about five times slower; with this limit Spark splits such a method per operator instead.
    """
    if int(spark.conf.get(_METHOD_LIMIT)) > _JIT_LIMIT:
        spark.conf.set(_METHOD_LIMIT, _JIT_LIMIT)
    return spark
