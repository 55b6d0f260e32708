import pytest

from wattline.errors import ContractError
from wattline.operators.contracts import ENGINEERED, RAW, Contract, Item, accepts, conformance, quarantine

RAW_DDL = "`Unnamed: 0` string, MT_001 string, MT_002 string, extra int"


def test_forms_of_a_contract():
    mapping = Contract({"a": "int"})
    dicts = Contract([{"column": "a", "type": "int"}])
    items = Contract([Item("int", column="a")])
    assert mapping.exact == dicts.exact == items.exact == {"a": "int"}
    with pytest.raises(TypeError):
        Contract("a")
    with pytest.raises(KeyError):
        Contract([{"type": "int"}])


@pytest.mark.parametrize(
    "expected, actual, ok",
    [
        ("object", "object", True), ("str", "object", True), ("float", "float64", True), ("int", "int32", True),
        ("int", "uint8", False), ("float", "float16", False), ("float64", "float64", True),
        ("datetime64[us]", "datetime64[us]", True), ("datetime64[us]", "datetime64[ns]", False), ("int64", "float64", False),
    ],
)
def test_type_names(expected, actual, ok):
    assert accepts(expected, actual) is ok


def test_patterns_expand_from_the_start_of_the_name_and_win(spark):
    contract = Contract([{"column": "MT_001", "type": "int"}, {"column_pattern": r"MT_\d{3}", "type": "float64"}])
    assert contract.expand(["MT_001", "MT_0022", "XMT_003"]) == {"MT_001": "float64", "MT_0022": "float64"}


def test_check_passes_with_extra_columns_and_without_matches(spark):
    assert Contract(RAW).check(spark.createDataFrame([], RAW_DDL)) is not None
    assert Contract(RAW).check(spark.createDataFrame([], "`Unnamed: 0` string")) is not None


def test_check_names_every_breach(spark):
    df = spark.createDataFrame([], "timestamp timestamp_ntz, hour_of_day int, day_of_week bigint, total_load double")
    with pytest.raises(ContractError, match="hour_of_day.*is_weekend|is_weekend.*hour_of_day"):
        Contract(ENGINEERED, "engineered").check(df)


def test_conformance_counts_cells_that_do_not_convert(spark):
    df = spark.createDataFrame([("1,5", "7"), ("x", "y"), (None, "3")], "MT_001 string, n string")
    contract = Contract([{"column": "n", "type": "int64"}, {"column": "gone", "type": "int64"}, {"column_pattern": "MT_", "type": "float64"}])
    got = {r["column"]: (r["kind"], r["cells"], r["bad_cells"]) for r in conformance(df, contract).collect()}
    assert got == {"n": ("type", 3, 1), "gone": ("missing", 0, 0), "MT_001": ("type", 2, 1)}


def test_quarantine_splits_all_rows(spark):
    data = [("2024-01-01 00:00:00", "1,5"), ("soon", "2"), (None, "2"), ("2024-01-01 00:15:00", "x"), ("2024-01-01 00:30:00", None)]
    df = spark.createDataFrame(data, "timestamp string, MT_001 string")
    good, bad = quarantine(df, Contract([{"column": "timestamp", "type": "datetime64[us]"}, {"column_pattern": "MT_", "type": "float64"}]))
    assert dict(good.dtypes) == {"timestamp": "timestamp_ntz", "MT_001": "double"}
    assert sorted((str(r["timestamp"]), r["MT_001"]) for r in good.collect()) == [("2024-01-01 00:00:00", 1.5), ("2024-01-01 00:30:00", None)]
    assert sorted(tuple(r["bad_columns"]) for r in bad.collect()) == [("MT_001",), ("timestamp",), ("timestamp",)]
    with pytest.raises(ContractError):
        quarantine(df, Contract({"gone": "int"}))
