"""Tables built from a parameter list. Nothing is hinted: the planner and AQE
broadcast by size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def sql_literal(value) -> str:
    """A Spark SQL literal for a Python value (strings escaped for the parser)."""
    import datetime as dt

    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, float) and (value != value or value in (float("inf"), float("-inf"))):
        return f"CAST('{value}' AS DOUBLE)"
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A DataFrame from a parameter list.

    Built as ``inline`` of a literal array over a one-row range, so it is a
    JVM-side plan: ``createDataFrame(list)`` would be a Python RDD scan that
    starts Python workers wherever it is read. The literal array is one SQL
    expression, so building it is a single parser call, not one call per value.
    """
    if not rows:
        return spark.createDataFrame([], schema)
    structs = ", ".join(
        "struct(" + ", ".join(
            f"CAST({sql_literal(v)} AS {f.dataType.simpleString()}) AS `{f.name}`"
            for v, f in zip(r, schema.fields, strict=True)
        ) + ")"
        for r in rows
    )
    return spark.range(0, 1, 1, 1).select(F.expr(f"inline(array({structs}))"))
