import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from conftest import values
from tidemark.operators.transform import (
    AuditColumns, TransformRules, audit, cast, derive, exclude, project, rename, transform,
)


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "ann", "s1", "p1", "12.345"), (2, "bob", "s2", "p2", "x")],
        "CUSTOMER_ID int, CUSTOMER_NAME string, SSN string, PASSWORD string, BALANCE string",
    )


def test_exclude_unites_lists_and_ignores_case_and_unknown(people):
    assert exclude(people, [" password ", "nope"], ["ssn"]).columns == ["CUSTOMER_ID", "CUSTOMER_NAME", "BALANCE"]
    assert exclude(people, None, []).columns == people.columns


def test_rename_skips_missing(people):
    out = rename(people, {"customer_id": "id", "missing": "x"})
    assert out.columns[0] == "id" and len(out.columns) == 5


def test_cast_uses_names_before_or_after_rename_and_is_lenient(people):
    renames = {"CUSTOMER_ID": "customer_key"}
    out = cast(rename(people, renames), {"customer_id": "BIGINT", "balance": "DECIMAL(18,2)", "gone": "INT", "SSN": "WRONG"}, renames)
    assert dict(out.dtypes)["customer_key"] == "bigint" and dict(out.dtypes)["SSN"] == "string"
    assert [str(r[0]) for r in out.select("BALANCE").collect()] == ["12.35", "None"]


def test_derived_in_order_replacing_and_raising(people):
    out = derive(people, {"a": "CUSTOMER_ID + 1", "b": "a * 2", "ssn": "'***'"})
    assert values(out, "a", "b", "ssn") == [(2, 4, "***"), (3, 6, "***")]
    with pytest.raises(AnalysisException):
        derive(people, {"a": "no_such_column + 1"}).columns


def test_audit_values_names_and_switch(people, monkeypatch):
    names = AuditColumns(insert_ts="i", updated_ts="u", run_id="r", job_user="w")
    out = audit(people, names, run_id=None, job_id="job_7", job_user="me", as_of=dt.datetime(2024, 1, 1))
    row = out.select("i", "u", "r", "w").first()
    assert row["i"] == row["u"] == dt.datetime(2024, 1, 1, 6) and (row["r"], row["w"]) == ("job_7", "me")
    assert audit(people).select("dwh_etl_run_id").first()[0] == "ETL_RUN_UNKNOWN"
    monkeypatch.setenv("USER", "env_user")
    assert audit(people).select("dwh_job_user").first()[0] == "env_user"
    assert audit(people, AuditColumns(enabled=False)).columns == people.columns


def test_whole_transform_is_one_projection(people):
    rules = TransformRules(("PASSWORD",), {"CUSTOMER_ID": "customer_id"}, {"CUSTOMER_ID": "BIGINT"}, {"source_system": "'ORACLE'"})
    out = transform(people, rules, ["ssn"], AuditColumns(), run_id="r1")
    assert out.columns == ["customer_id", "CUSTOMER_NAME", "BALANCE", "source_system",
                           "dwh_insert_ts", "dwh_updated_ts", "dwh_etl_run_id", "dwh_job_user"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") <= 1 and "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert transform(None, rules) is None


def test_project_is_case_insensitive_and_strict(people):
    assert project(people, ["customer_name", "SSN"]).columns == ["CUSTOMER_NAME", "SSN"]
    assert project(people, None).columns == people.columns
    with pytest.raises(ValueError):
        project(people, ["nope"])
