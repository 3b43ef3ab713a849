"""Whole runs, with the published results of the contact and employee pairs.

The rows here are invented; keys and planted differences follow the pairs.
"""

import pytest

from tallyframe import ALL_CHECKS, Environment, as_published, as_published_short, validate
from tallyframe.operators import CompareOptions, Comparison, compare_columns, only_in_source, only_in_target
from tallyframe.plans import grouped_cases, read_plan, run_cases, run_plan
from tallyframe.plans.medallion import CONTACT_COLUMNS
from tallyframe.plans.suite import checks_named
from tallyframe.results import Names
from tallyframe.schema import PLAN_LOCATION_COLUMNS, PLAN_SCHEMA
from tests.helpers import results, rows


def contact(number, **changed):
    row = {name: f"{name} {number}" for name in CONTACT_COLUMNS} | {
        "Identifier": str(number),
        "middle_initial": None,
        "suffix": None,
    }
    return tuple((row | changed).values())


@pytest.fixture(scope="module")
def contact_pair(spark):
    source = [contact(n) for n in range(1, 11)]
    target = [
        contact(1, Email="other"),
        contact(2),
        contact(3, city_prev="other", zipcode_prev="other"),
        contact(4),
        contact(5),
        contact(6, Primary_street_number="other"),
        *[contact(n) for n in (7, 8, 9, 11, 12, 12)],
    ]
    schema = ", ".join(f"{name} string" for name in CONTACT_COLUMNS)
    return spark.createDataFrame(source, schema), spark.createDataFrame(target, schema)


def test_contact_checks(contact_pair):
    source, target = contact_pair
    checked = results(
        validate(
            source,
            target,
            keys="Identifier",
            null_columns="Identifier, Surname, middle_initial, suffix",
            unique_columns="Identifier",
            names=Names("contacts", "contacts_copy"),
            count_qa=10,
        )
    )
    assert checked == {
        (1, "Identifier"): (10, 12, 2, "fail"),
        (2, "Identifier"): (None, 12, 1, "fail"),
        (3, "Identifier"): (None, 12, 1, "fail"),
        (4, "Identifier"): (None, 12, 0, "pass"),
        (4, "Surname"): (None, 12, 0, "pass"),
        (4, "middle_initial"): (None, 12, 12, "fail"),
        (4, "suffix"): (None, 12, 12, "fail"),
        (5, "Identifier"): (10, 12, 2, "fail"),
        (6, "Identifier"): (10, 12, 1, "fail"),
        (7, "Identifier"): (10, 12, 39, "fail"),
    }


def test_contact_columns(contact_pair):
    source, target = contact_pair
    summary = {
        r["column"]: (r["total"], r["match_count"], r["mismatch_count"], r["mismatch_pct"])
        for r in compare_columns(source, target, "Identifier", count_qa=10).collect()
    }
    assert len(summary) == 17
    changed = {"Email", "city_prev", "zipcode_prev", "Primary_street_number"}
    for name, figures in summary.items():
        if name in ("middle_initial", "suffix"):
            assert figures == (10, 0, 10, 100.0)
        elif name in changed:
            assert figures == (10, 8, 2, 20.0)
        else:
            assert figures == (10, 9, 1, 10.0)


def test_employee_pair_whose_key_differs_in_case(spark):
    numbers = [*range(7801, 7811), 7654, 7876, 7876]
    source = spark.createDataFrame([(str(n), " a ") for n in numbers], "EMPNO string, ENAME string")
    copy = [5655 if n == 7654 else n for n in numbers]
    target = spark.createDataFrame([(str(n), "a") for n in copy], "Empno string, ename string")
    assert rows(only_in_source(source, target, "EMPNO")) == [("7654", 1)]
    assert rows(only_in_target(source, target, "EMPNO")) == [("5655", 1)]
    checked = results(
        validate(source, target, keys="EMPNO", checks=["duplicate", "data_compare"])
    )
    # Key 7876 stands twice on both sides, all alike; 7654 has no partner.
    assert checked == {
        (2, "EMPNO"): (None, 13, 1, "fail"),
        (7, "EMPNO"): (13, 13, 1, "fail"),
    }


def test_same_data_passes_everything(spark):
    df = spark.range(20).selectExpr("id", "cast(id as string) as a")
    checked = results(
        validate(df, df, keys="id", null_columns="a", unique_columns="a")
    )
    assert {v[3] for v in checked.values()} == {"pass"} and len(checked) == 7


KEY_CHECKS = (
    "count_validation",
    "duplicate",
    "records_present_only_in_target",
    "records_present_only_in_source",
)


@pytest.mark.parametrize(
    "key, shared",
    [
        ("k int", True),
        ("k string", True),
        ("k double", False),
        ("concat(' ', k) string", False),
    ],
)
def test_key_checks_come_with_the_comparison(spark, key, shared):
    """The same result rows with and without sharing the pass over the keys."""
    form, kind = key.rsplit(" ", 1)
    schema = "k int, a string"
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "c")], schema)
    right = spark.createDataFrame([(1, "a"), (1, "x"), (3, "d"), (None, "c")], schema)
    left = left.selectExpr(f"cast({form} as {kind}) as k", "a")
    right = right.selectExpr(f"cast(k as {kind}) as k", "a")
    assert Comparison(left, right, "k").answers_key_checks == shared
    together = results(validate(left, right, keys="k", checks=[*KEY_CHECKS, "data_compare"]))
    alone = {}
    for name in KEY_CHECKS:
        alone |= results(validate(left, right, keys="k", checks=[name]))
    assert {k: v for k, v in together.items() if k[0] != 7} == alone


def test_empty_text_keys_share_too(spark):
    empty = spark.createDataFrame([], "k string, a string")
    checked = results(validate(empty, empty, keys="k", checks=[*KEY_CHECKS, "data_compare"]))
    assert {v[3] for v in checked.values()} == {"pass"} and len(checked) == 5


def test_published_headings(contact_pair):
    source, target = contact_pair
    checked = validate(source, target, keys="Identifier", checks=["count_validation"])
    assert as_published(checked).columns == [
        "TC_ID",
        "test_Case_Name",
        "Source_name",
        "target_name",
        "Number_of_source_Records",
        "Number_of_target_Records",
        "Number_of_failed_Records",
        "column",
        "Status",
    ]
    assert as_published_short(checked).columns == [
        "TC_ID",
        "test_Case_Name",
        "Number_of_source_Records",
        "Number_of_target_Records",
        "Number_of_failed_Records",
        "Status",
    ]


def test_check_names():
    assert len(checks_named(ALL_CHECKS)) == 7
    assert checks_named(["uniqueness_check"]) == checks_named([" Uniquess_check"])
    with pytest.raises(ValueError, match="unknown checks"):
        checks_named(["no_such_check"])


@pytest.fixture
def plan_folder(spark, tmp_path):
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "s.csv").write_text("id,v\n1,a\n2,b\n3,\n")
    (tmp_path / "data" / "t.csv").write_text("id,v\n1,a\n2,x\n2,x\n")
    lines = [",".join(PLAN_SCHEMA.names)]
    for check, active in (
        ("count_validation", "Y"),
        ("duplicate", "Y"),
        ("duplicate", "Y"),
        ("Null_value_check", "N"),
        ("data_compare", "Y"),
        ("records_present_only_in_source", "Y"),
    ):
        lines.append(f"s.csv,csv,NA,NA,t.csv,CSV,NA,NA,id,v,id,{check},{active}")
    lines.append('t.csv,csv,NA,NA,s.csv,csv,NA,NA,"id, v",v,"id,v",Uniquess_check,Y')
    (tmp_path / "plan.csv").write_text("\n".join(lines) + "\n")
    return tmp_path


@pytest.mark.parametrize("store_rows", [False, True, None])
def test_plan_run(spark, plan_folder, store_rows):
    plan = read_plan(spark, "csv", str(plan_folder / "plan.csv"))
    assert plan.schema.names == PLAN_SCHEMA.names
    env = Environment(data_root=str(plan_folder / "data"), store_rows=store_rows)
    assert results(run_plan(plan, env)) == {
        (1, "id"): (3, 3, 0, "pass"),
        (2, "id"): (None, 3, 1, "fail"),
        (6, "id"): (3, 3, 1, "fail"),
        (7, "id"): (3, 3, 2, "fail"),
        (3, "id"): (None, 3, 0, "pass"),
        (3, "v"): (None, 3, 0, "pass"),
    }
    cases = [case for case, _ in run_cases(plan, env)]
    assert [case["source"] for case in cases] == ["s.csv", "t.csv"]


def test_grouped_cases_collect_each_check_once(spark, plan_folder):
    plan = read_plan(spark, "csv", str(plan_folder / "plan.csv"))
    grouped = grouped_cases(plan)
    assert grouped.columns == [*PLAN_LOCATION_COLUMNS, "validation_Type"]
    first = grouped.filter("source = 's.csv'").filter("target_type = 'CSV'").first()
    assert first["validation_Type"] == [
        "Null_value_check",
        "count_validation",
        "data_compare",
        "duplicate",
        "records_present_only_in_source",
    ]


def test_grouping_of_a_plan_with_other_columns(spark):
    plan = spark.createDataFrame(
        [("a", "q1", "x"), ("a", "q1", "y"), ("a", "q1", "x"), ("b", None, "x")],
        "file string, query string, kind string",
    )
    grouped = grouped_cases(plan, ["file", "query"], "kind")
    assert rows(grouped) == [("a", "q1", ["x", "y"]), ("b", None, ["x"])]


def test_plan_with_unknown_check_fails(spark):
    spark.range(1).createOrReplaceTempView("plan_v")
    row = ("plan_v", "view", None, None, "plan_v", "view", None, None, "id", "", "", "oops", "Y")
    plan = spark.createDataFrame([row], PLAN_SCHEMA)
    with pytest.raises(ValueError, match="oops"):
        run_plan(plan)
    with pytest.raises(ValueError, match="nothing"):
        run_plan(plan.filter("execution_ind = 'N'"))


def test_plan_reads_each_side_by_its_own_options(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id|v\n1|a\n2|1.0\n")
    (tmp_path / "t.json").write_text('[{"id": "1",\n "v": "a"},\n {"id": "2",\n "v": "1.4"}]')
    case = ("s.csv", "csv", "NA", "NA", "t.json", "json", "NA", "NA", "id", "v", "id")
    plan = spark.createDataFrame(
        [(*case, check, "Y") for check in ("count_validation", "data_compare")], PLAN_SCHEMA
    )
    env = Environment(
        data_root=str(tmp_path),
        readers={"s.csv": {"delimiter": "|"}, "t.json": {"multiline": True}},
    )
    assert results(run_plan(plan, env))[7, "id"] == (2, 2, 1, "fail")
    wide = {"s.csv": CompareOptions(tolerance={"v": "0.5"})}
    assert results(run_plan(plan, env, lambda case: wide[case["source"]])) == {
        (1, "id"): (2, 2, 0, "pass"),
        (7, "id"): (2, 2, 0, "pass"),
    }


def test_a_file_is_read_once_for_several_checks(spark, plan_folder):
    plan = read_plan(spark, "csv", str(plan_folder / "plan.csv"))
    env = Environment(data_root=str(plan_folder / "data"))
    texts = [
        checked._jdf.queryExecution().optimizedPlan().toString()
        for _, checked in run_cases(plan, env)
    ]
    # The second case has one check, on files that the first one reads for several.
    assert len(texts) == 2 and not any(" csv" in text for text in texts)
    alone = plan.filter("validation_Type = 'count_validation'")
    [(_, checked)] = run_cases(alone, env)
    assert " csv" in checked._jdf.queryExecution().optimizedPlan().toString()


def test_cases_on_one_file_share_one_scan(spark, tmp_path, monkeypatch):
    """Three cases and two null lists: one read of the file, and figures from that read."""
    import tallyframe.plans.runner as runner

    (tmp_path / "s.csv").write_text("id,v\n1,a\n2,\n2,None\n")
    (tmp_path / "t.csv").write_text("id,v\n1,a\n2,x\n")
    pair = ("s.csv", "csv", None, None, "s.csv", "csv", None, None)
    other = ("t.csv", "csv", None, None, "s.csv", "csv", None, None)
    cases = [
        (*pair, "id", "id, v", "", "count_validation", "Y"),
        (*pair, "id", "id, v", "", "Null_value_check", "Y"),
        (*pair, "id", "v", "id", "Uniquess_check", "Y"),
        (*pair, "id", "v", "id", "Null_value_check", "Y"),
        (*other, "id", "", "", "count_validation", "Y"),
        (*other, "id", "", "", "records_present_only_in_target", "Y"),
    ]
    asked = []
    read = runner.read_data
    monkeypatch.setattr(runner, "read_data", lambda *a, **b: asked.append(a[2]) or read(*a, **b))
    made = run_cases(spark.createDataFrame(cases, PLAN_SCHEMA), Environment(data_root=str(tmp_path)))
    found = []
    for _, frame in made:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "FileScan csv" not in plan
        found.append(sorted((r["tc_id"], r["column"], r["source_records"], r["target_records"], r["failed_records"]) for r in frame.collect()))
    assert sorted(asked) == [str(p) for p in (tmp_path / "s.csv", tmp_path / "t.csv")]
    assert found == [
        [(1, "id", 3, 3, 0), (4, "id", None, 3, 0), (4, "v", None, 3, 2)],
        [(3, "id", None, 3, 1), (4, "v", None, 3, 2)],
        [(1, "id", 2, 3, 1), (5, "id", 2, 3, 0)],
    ]


def test_known_figures_need_no_scan(spark, tmp_path):
    from tallyframe.plans import Figures

    spark.range(5).selectExpr("id", "cast(null as string) v").write.parquet(f"{tmp_path}/x")
    df = spark.read.parquet(f"{tmp_path}/x")
    known = Figures(5, {"id": 0, "v": 5})
    checked = validate(
        df, df, keys="id", null_columns="v, id", checks=["count_validation", "Null_value_check"],
        source_figures=known, target_figures=known,
    )
    assert "FileScan" not in checked._jdf.queryExecution().executedPlan().toString()
    plain = validate(df, df, keys="id", null_columns="v, id", checks=["count_validation", "Null_value_check"])
    assert rows(checked) == rows(plain)
