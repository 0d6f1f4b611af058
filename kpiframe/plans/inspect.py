"""Plan inspection: check a DataFrame's physical plan before running it at scale.

Helpers read the formatted ``explain`` output (the public plan text):
pushed filters per scan, scans per table, and plan nodes that should not be
there (Python evaluation, cartesian products, nested-loop joins, Python-RDD
scans).
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

FORBIDDEN_NODES = (
    "BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas",
    "CartesianProduct", "BroadcastNestedLoopJoin", "Scan ExistingRDD",
)


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def pushed_filters(text: str) -> list[str]:
    """``PushedFilters`` of every scan, in plan order."""
    return re.findall(r"PushedFilters: \[(.*)\]", text)


def read_schemas(text: str) -> list[str]:
    return re.findall(r"ReadSchema: struct<([^>]*)>", text)


def scan_count(text: str, table: str) -> int:
    """Number of scans of ``<table>.parquet`` (or a directory named ``table``)."""
    return len(re.findall(rf"Location: InMemoryFileIndex \[[^\]]*/{re.escape(table)}(?:\.parquet)?\]", text))


def forbidden_nodes(text: str) -> list[str]:
    return [n for n in FORBIDDEN_NODES if n in text]


def assert_plan_ok(df: DataFrame) -> str:
    """Raise if the plan has a forbidden node; return the plan text."""
    text = explain_text(df)
    bad = forbidden_nodes(text)
    if bad:
        raise AssertionError(f"plan contains {bad}")
    return text
