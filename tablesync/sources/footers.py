"""Least and greatest values of columns out of file footers, without reading a row."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

_log = logging.getLogger(__name__)

_FORMATS = ("parquet", "orc")
# Types whose footers hold exact bounds and that Spark pushes an aggregate for.
_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


def footer_bounds(
    spark: SparkSession, format: str, options: Mapping[str, str], path: str, schema: T.StructType, columns: Sequence[str],
) -> DataFrame | None:
    """One row (lo, hi): least and greatest value of the whole numbers or dates in ``columns``.

    None where footers cannot tell: for other formats and types, or columns of several types. The
    aggregate is pushed to the reader, which is a setting of the session, so it has a session of its own.
    """
    if format not in _FORMATS or not columns or not set(columns) <= set(schema.names):
        return None
    types = {type(schema[c].dataType) for c in columns}
    if len(types) > 1 or not types <= set(_EXACT):
        return None
    side = spark.newSession()
    side.conf.set("spark.sql.sources.useV1SourceList", "")
    side.conf.set(f"spark.sql.{format}.aggregatePushdown", "true")
    rows = side.read.format(format).options(**options).schema(schema).load(path)
    names = [f"`{c.replace('`', '``')}`" for c in columns]
    if len(names) == 1:
        return rows.agg(F.min(names[0]).alias("lo"), F.max(names[0]).alias("hi"))
    return rows.agg(F.least(*[F.min(c) for c in names]).alias("lo"), F.greatest(*[F.max(c) for c in names]).alias("hi"))


def newest_by_footers(bounds: DataFrame | None, lower: str | None) -> DataFrame | None:
    """One row (hi): the greatest value, NULL if the condition ``lower`` on it fails. None where a file
    has no footer statistics to tell it, as when all of a row group is NULL.

    With a lower bound only, the greatest value of all rows is that of the rows at or past the bound.
    """
    if bounds is None:
        return None
    try:
        high = bounds.first()["hi"]
    except (Py4JJavaError, PySparkException) as no:
        _log.info("bounds are read from rows, as footers lack them: %s", str(no).splitlines()[0])
        return None
    found = bounds.sparkSession.createDataFrame([(high,)], T.StructType([T.StructField("hi", bounds.schema["hi"].dataType)]))
    return found if lower is None else found.select(F.when(F.expr(lower), F.col("hi")).alias("hi"))
