from sluice.operators.contracts import (
    closed_set_rule,
    closed_set_violations,
    length_rule,
    not_null_rule,
    rule_counts,
    foreign_key_violations,
    length_violations,
    not_null_violations,
    primary_key_violations,
    violation_counts,
)
from sluice.operators.loads import read_or_empty
from sluice.schemas import CALL_LOG


def test_checks(spark, tmp_dir):
    users = spark.createDataFrame([("u1",), ("u2",), ("u2",), (None,)], "user_id string")
    sessions = spark.createDataFrame([("s1", "u1"), ("s2", "u9"), ("s3", None)], "session_id string, user_id string")
    pk = primary_key_violations(users, ["user_id"]).collect()
    assert sorted((r["user_id"] or "", r["n_rows"]) for r in pk) == [("", 1), ("u2", 2)]
    assert [r["session_id"] for r in foreign_key_violations(sessions, users, ["user_id"], ["user_id"]).collect()] == ["s2"]
    assert not_null_violations(sessions, ["user_id"]).count() == 1
    calls = spark.createDataFrame([("c1", "DE-HE"), ("c2", "FR-XX"), ("c3", None)], "call_id string, region_code string")
    assert [r["call_id"] for r in closed_set_violations(calls, "region_code", ["DE-HE", "DE-BY"]).collect()] == ["c2"]
    assert length_violations(calls, "region_code", 4).count() == 2
    summary = {r["check_name"]: r["n_violations"] for r in violation_counts({
        "pk": primary_key_violations(users, ["user_id"]),
        "fk": foreign_key_violations(sessions, users, ["user_id"], ["user_id"]),
    }).collect()}
    assert summary == {"pk": 2, "fk": 1}
    rules = {r["check_name"]: r["n_violations"] for r in rule_counts(calls, {
        "region_set": closed_set_rule("region_code", ["DE-HE", "DE-BY"]),
        "region_len": length_rule("region_code", 4),
        "region_nn": not_null_rule(["region_code"]),
    }).collect()}
    assert rules == {"region_set": 1, "region_len": 2, "region_nn": 1}
    empty = read_or_empty(spark, f"{tmp_dir}/missing", CALL_LOG)
    assert empty.count() == 0 and empty.schema == CALL_LOG


def test_enforcing_load_splits_rows_by_their_reasons(spark, tmp_dir):
    from sluice.operators.contracts import closed_set_rule, enforcing_load, length_rule, not_null_rule

    schema = "k int, parent int, kind string"
    data = [(1, 1, "a"), (2, 9, "a"), (3, None, "b"), (4, 1, "zz"), (4, 1, "a"), (None, 1, "a"), (7, 1, None), (8, 9, "long")]
    parents = spark.createDataFrame([(1,), (1,)], "id int")
    rules = {"kind": closed_set_rule("kind", ["a", "b", "zz"]), "length": length_rule("kind", 2), "given": not_null_rule(["kind"])}
    for _ in range(2):  # a second load is added to both
        n = enforcing_load(spark, spark.createDataFrame(data, schema), f"{tmp_dir}/t", f"{tmp_dir}/q", rules,
                           keys=["k"], parents={"fk": (["parent"], parents, ["id"])})
        assert n == {"loaded": 2, "quarantined": 6, "kind": 1, "length": 1, "given": 1, "primary_key": 3, "fk": 2}
    good = sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/t").collect()))
    assert good == sorted(2 * [(1, 1, "a"), (3, None, "b")], key=repr)
    bad = {(r.k, r.kind): r.reasons for r in spark.read.parquet(f"{tmp_dir}/q").collect()}
    assert bad == {
        (2, "a"): ["fk"], (4, "zz"): ["primary_key"], (4, "a"): ["primary_key"], (None, "a"): ["primary_key"],
        (7, None): ["given"], (8, "long"): ["kind", "length", "fk"],
    }
