import math

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions.numeric import nan_to_null, to_number
from wattline.operators.clean import coerce_numeric, normalize_decimals, scale_meters, select_meters, to_long
from wattline.errors import OptionError

TOKENS = [
    "inf", "-Infinity", "nan", "1.5d", "1f", "0x10", "0x1p3", "1_000", " 2 ", "1e3", "", "+3", ".5", "5.", "True",
    "1,5", "1,234,5", "-0", "1e", "NA", "null", ".", "-", "-.", "--1", "12-3", "1.2.3", "007", "-3,25", "9" * 30,
]


def test_text_to_number_agrees_with_pandas(spark):
    df = spark.createDataFrame([(t,) for t in TOKENS], "t string")
    got = {r["t"]: r["n"] for r in df.select("t", to_number(F.col("t"), T.StringType()).alias("n")).collect()}
    for token in TOKENS:
        want = pd.to_numeric(pd.Series([token.replace(",", ".")], dtype=object), errors="coerce").iloc[0]
        if isinstance(want, bool) or (isinstance(want, float) and math.isnan(want)):
            assert got[token] is None, token
        else:
            assert got[token] == pytest.approx(want, rel=1e-15), token  # pandas rounds the last bit of long numbers


def test_coercion_of_columns_agrees_with_the_expression(spark):
    df = spark.createDataFrame([(t, 1.0, "x") for t in TOKENS], "MT_001 string, MT_002 double, note string")
    one = df.select(to_number(F.col("MT_001"), T.StringType())).collect()
    both = coerce_numeric(df, factor=0.25)
    assert both.columns == df.columns
    got = both.collect()
    assert [r["MT_001"] for r in got] == [None if r[0] is None else r[0] * 0.25 for r in one]
    assert {(r["MT_002"], r["note"]) for r in got} == {(0.25, "x")}


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert [r[0] for r in df.select(nan_to_null(F.col("x"))).collect()] == [None, 1.0, None]


def test_decimal_commas_change_in_text_only(spark):
    df = spark.createDataFrame([("1,5", 2.5, "a,b")], "MT_001 string, MT_002 double, note string")
    assert normalize_decimals(df, ["MT_001", "MT_002"]).first().asDict() == {"MT_001": "1.5", "MT_002": 2.5, "note": "a,b"}


def test_meter_columns_by_name(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "timestamp int, MT_001 int, MT_0011 int, XMT_001 int")
    assert select_meters(df).columns == ["timestamp", "MT_001"]
    assert scale_meters(df, 0.5).first()["MT_001"] == 1.0


def test_long_form_keeps_missing_cells(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 3.0, 4.0)], "timestamp int, MT_001 double, MT_002 double")
    got = sorted((r["timestamp"], r["meter_id"], r["value"] or 0.0) for r in to_long(df).collect())
    assert got == [(1, "MT_001", 1.0), (1, "MT_002", 0.0), (2, "MT_001", 3.0), (2, "MT_002", 4.0)]
    with pytest.raises(OptionError):
        to_long(df.select("timestamp"))
