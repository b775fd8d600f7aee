import pytest

from panelspark.config import Contract, gold_contract
from panelspark.operators import checks

CONTRACT = Contract(
    types={"k": "string", "x": "double", "y": "int"}, not_null=("y",), ranges={"x": (0, 1), "y": (0, 1)},
    allowed={"k": ("a", "b", None)},
)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, x double, y int, more string")


def test_good_table(spark):
    df = frame(spark, [("a", 0.0, 0, ""), (None, 1.0, 1, ""), ("b", None, 1, "")])
    assert all(checks.validate(df, CONTRACT))


def test_counts_equal_a_look_at_every_row(spark):
    rows = [("a", 0.0, 0, ""), ("c", 1.5, None, ""), ("b", -0.1, 2, ""), (None, None, 1, ""), ("c", 0.5, 1, "")]
    found = {(r["check"], r["column_name"]): r["n_bad"] for r in checks.run_row_checks(frame(spark, rows), CONTRACT).collect()}
    assert found == {
        ("not_null", "y"): sum(r[2] is None for r in rows),
        ("range", "x"): sum(r[1] is not None and not 0 <= r[1] <= 1 for r in rows),
        ("range", "y"): sum(r[2] is not None and not 0 <= r[2] <= 1 for r in rows),
        ("allowed", "k"): sum(r[0] not in ("a", "b", None) for r in rows),
    }
    assert checks.validate(frame(spark, rows), CONTRACT) == (True, False, False, False)


def test_types(spark):
    df = spark.createDataFrame([("a", 1, 1)], "k string, x int, y int")
    assert checks.wrong_types(df, CONTRACT.types) == [("x", "double", "int")]
    assert not checks.validate(df.drop("k"), CONTRACT).schema_check
    assert not checks.validate(df.drop("k"), CONTRACT).categorical_options


def test_row_checks_are_one_scan(spark):
    plan = checks.run_row_checks(frame(spark, [("a", 0.0, 0, "")]), CONTRACT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_key_check(spark):
    df = frame(spark, [("a", 0.0, 0, ""), ("a", 0.0, 1, ""), ("b", 0.0, 1, "")])
    assert tuple(checks.duplicate_keys(df, ("k",)).first()) == (2, 1)
    keyed = Contract(types=CONTRACT.types, unique_key=("k",))
    assert not checks.validate(df, keyed).schema_check


def test_gold_contracts():
    train, serving = gold_contract(), gold_contract(serving=True)
    assert len(train.types) == 30 and len(serving.types) == 28
    assert train.not_null == ("long_term_care_responder",) and serving.not_null == ()
    assert "set_type" in train.allowed and "set_type" not in serving.allowed
    assert len(train.ranges) == 9 and len(serving.ranges) == 8


def test_signature(spark):
    df = frame(spark, [("a", 0.0, 0, "")])
    signature = checks.schema_signature(df, ["x", "k"])
    given = spark.createDataFrame([("a", 3, "id")], "k string, x int, id string")
    found = checks.enforce_signature(given, signature)
    assert found.columns == ["id", "x", "k"] and found.first()["x"] == 3.0
    with pytest.raises(ValueError, match="missing"):
        checks.enforce_signature(given.drop("k"), signature)
    with pytest.raises(ValueError, match="trained on"):
        checks.enforce_signature(given.selectExpr("x as k", "cast(x as string) as x"), signature)


@pytest.mark.parametrize("kind, allowed", [
    ("tinyint", True), ("smallint", True), ("int", True), ("float", True), ("bigint", False), ("decimal(9,2)", False), ("string", False)])
def test_only_types_without_loss_widen(spark, kind, allowed):
    signature = checks.schema_signature(spark.range(1).selectExpr("double(id) AS x"), ["x"])
    given = spark.range(1).selectExpr(f"cast(id AS {kind}) AS x")
    if allowed:
        assert checks.enforce_signature(given, signature).schema["x"].dataType.simpleString() == "double"
    else:
        with pytest.raises(ValueError, match="trained on"):
            checks.enforce_signature(given, signature)


def test_type_check(spark):
    df = spark.range(1).selectExpr("id AS a", "int(id) AS b")
    found = checks.type_check(df, {"a": "bigint", "b": "double", "c": "string"}).collect()
    assert [tuple(r) for r in found] == [("a", "bigint", "bigint", True), ("b", "double", "int", False), ("c", "string", None, False)]
