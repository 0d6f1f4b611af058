from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kpiframe import labels as L
from kpiframe.functions.text import (
    cast_number, fixed2, float_number, growth_phrase, join_list, percent2, summary_sentence, thousands,
)


def py_g1(g):
    if g is None or g == 0:
        return L.FLAT_TEXT
    num = f"{abs(g):.2f}".rstrip("0").rstrip(".")
    return (L.UP_PREFIX if g > 0 else L.DOWN_PREFIX) + num + "%"


def py_g3(g):
    if g is None or g == 0:
        return L.FLAT_TEXT
    return (L.UP_PREFIX if g > 0 else L.DOWN_PREFIX) + f"{abs(g)}%"


def py_g4(cur, prev):
    if prev == 0:
        return L.TRAFFIC_NA_TEXT
    g = (cur - prev) / prev * 100
    if g > 0:
        return f"{L.UP_PREFIX}{g:.2f}%"
    if g < 0:
        return f"{L.DOWN_PREFIX}{g:.2f}%"
    return L.TRAFFIC_FLAT_TEXT


def test_thousands_and_fixed(spark):
    df = spark.createDataFrame([(1234567,), (-1234567,), (None,), (0,), (999,)], "n bigint")
    got = [r[0] for r in df.select(thousands(F.col("n"))).collect()]
    assert got == ["1.234.567", "-1.234.567", None, "0", "999"]
    df = spark.createDataFrame([(0.125,), (1234.5,), (None,), (-0.004,)], "x double")
    got = [tuple(r) for r in df.select(fixed2(F.col("x")), percent2(F.col("x"))).collect()]
    assert got == [("0.12", "0.12%"), ("1234.50", "1234.50%"), (None, None), ("-0.00", "-0.00%")]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.floats(min_value=-1e7, max_value=1e7, allow_nan=False), min_size=1, max_size=40))
def test_fixed2_matches_python(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(fixed2(F.col("x"))).collect()]
    assert got == [f"{x:.2f}" for x in xs]


def test_number_styles(spark):
    vals = [60.0, 18.6, 10.53, 12.0, 1.5, 100.0, 0.1]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    rows = df.select(cast_number(F.col("x")), float_number(F.col("x"))).collect()
    assert [r[0] for r in rows] == ["60", "18.6", "10.53", "12", "1.5", "100", "0.1"]
    assert [r[1] for r in rows] == [str(v) for v in vals]


def test_growth_phrases_g1_g2_g3(spark):
    vals = [60.0, -18.6, 0.0, None, 0.004, 1234.5, -0.01]
    df = spark.createDataFrame([(v,) for v in vals], "g double")
    rounded = F.round(F.col("g"), 2)
    rows = df.select(growth_phrase(rounded, "cast"), growth_phrase(rounded, "fixed2"),
                     growth_phrase(rounded, "float")).collect()
    for v, r in zip(vals, rows, strict=True):
        rv = None if v is None else round(v, 2)
        assert r[0] == py_g1(rv)
        assert r[1] == (L.FLAT_TEXT if not rv else (L.UP_PREFIX if rv > 0 else L.DOWN_PREFIX) + f"{abs(rv):.2f}%")
        assert r[2] == py_g3(rv)


def test_traffic_phrase(spark):
    pairs = [(105.0, 100.0), (95.0, 100.0), (100.0, 100.0), (5.0, 0.0), (100.004, 100.0), (1.0, 3.0)]
    df = spark.createDataFrame(pairs, "cur double, prev double")
    g = F.try_divide(F.col("cur") - F.col("prev"), F.col("prev")) * 100
    got = [r[0] for r in df.select(growth_phrase(g, "traffic", prev=F.col("prev"), cur=F.col("cur"))).collect()]
    assert got == [py_g4(c, p) for c, p in pairs]
    assert got[1] == "menurun sebanyak -5.00%"
    assert got[4] == "meningkat sebanyak 0.00%"
    none = spark.createDataFrame([(1.0, None)], "cur double, prev double")
    assert none.select(growth_phrase(F.lit(None), "traffic", prev=F.col("prev"))).first()[0] is None


def test_join_list_and_summary(spark):
    lists = [[], ["a"], ["a", "b"], ["a", "b", "c"]]
    df = spark.createDataFrame([(x,) for x in lists], "l array<string>")
    rows = df.select(join_list(F.col("l")), summary_sentence(F.col("l"))).collect()
    assert [r[0] for r in rows] == [None, "a", "a dan b", "a, b dan c"]
    assert rows[0][1] == L.SUMMARY_NONE
    assert rows[3][1] == "a, b dan c" + L.SUMMARY_SUFFIX
