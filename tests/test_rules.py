"""Rule files: grammar, compilation, errors that name their line."""

import datetime
import json

import pytest

from ledgerlake.operators.gates import Rule, dq_scan
from ledgerlake.operators.rules import MOST_BYTES, RuleError, compile_rules, read_rules, scan_with_file

ROWS = [
    (1, "a", 5.0, datetime.date(2024, 1, 1), True), (2, "b", -1.0, datetime.date(2024, 2, 1), False), (2, None, None, None, None),
    (3, "zz", 9.5, datetime.date(2025, 1, 1), True),
]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, "id int, name string, amount double, day date, `odd name` boolean")


RULES = [
    {"rule": "id", "kind": "unique", "columns": ["id"], "threshold": 0.5},
    {"rule": "named", "kind": "not_null", "columns": ["name"]},
    {"rule": "positive", "kind": "range", "columns": ["amount"], "low": 0},
    {"rule": "in 2024", "kind": "range", "columns": ["day"], "low": "2024-01-01", "high": "2024-12-31"},
    {"rule": "known", "kind": "set", "columns": ["name"], "values": ["a", "b"]},
    {"rule": "short", "kind": "regex", "columns": ["name"], "pattern": "^[a-z]$"},
    {"rule": "either", "kind": "row", "condition": {"any": [
        {"is_null": "amount"}, {"all": [{"left": {"column": "amount"}, "op": ">", "right": {"column": "id"}}, {"not": {"left": {"column": "odd name"}, "op": "=", "right": {"value": False}}}]},
    ]}},
]


def test_a_rule_file_gives_the_scan_of_its_rules(spark, table, tmp_path):
    path = tmp_path / "rules.jsonl"
    path.write_text("# rules of the table\n\n" + "\n".join(map(json.dumps, RULES)) + "\n")
    got = {r.rule: (r.evaluated, r.passed, r.ok) for r in scan_with_file(table, str(path)).collect()}
    assert got == {
        "id": (4, 3, True), "named": (4, 3, False), "positive": (3, 2, False), "in 2024": (3, 2, False), "known": (3, 2, False), "short": (3, 2, False),
        "either": (4, 3, False),
    }
    plain = [Rule("positive", "range", ("amount",), (0, None)), Rule("known", "set", ("name",), ("a", "b"))]
    same = dq_scan(table, [r for r in read_rules(spark, str(path), table.schema) if r.name in ("positive", "known")])
    assert sorted(map(str, same.collect())) == sorted(map(str, dq_scan(table, plain).collect()))


def test_one_pass(table, plan_of):
    rules = compile_rules([json.dumps(r) for r in RULES if r["kind"] != "unique"], table.schema)
    assert plan_of(dq_scan(table, rules), "simple").count("Scan ExistingRDD") == 1


def test_rules_come_by_groups(spark, table, tmp_path):
    (tmp_path / "r.jsonl").write_text(json.dumps(RULES[1]))
    got = {(r.id, r.evaluated, r.passed) for r in scan_with_file(table, str(tmp_path), ["id"]).collect()}
    assert got == {(1, 1, 1), (2, 2, 1), (3, 1, 1)}


@pytest.mark.parametrize(("line", "says"), [
    ("{", "no JSON"), ("[]", "object"), ('{"rule": ""}', "name"), ('{"rule": "x", "kind": "sql"}', "kind"),
    ('{"rule": "x", "kind": "not_null", "columns": ["nobody"]}', "nobody"), ('{"rule": "x", "kind": "not_null", "columns": ["id", "name"]}', "one column"),
    ('{"rule": "x", "kind": "not_null", "columns": []}', "columns"), ('{"rule": "x", "kind": "not_null", "columns": ["id"], "sql": "drop"}', "sql"),
    ('{"rule": "x", "kind": "not_null", "columns": ["id"], "threshold": 2}', "threshold"), ('{"rule": "x", "kind": "range", "columns": ["id"]}', "bound"),
    ('{"rule": "x", "kind": "range", "columns": ["id"], "low": "1"}', "compared"), ('{"rule": "x", "kind": "range", "columns": ["day"], "low": "yesterday"}', "date"),
    ('{"rule": "x", "kind": "set", "columns": ["name"], "values": [1]}', "compared"), ('{"rule": "x", "kind": "set", "columns": ["name"], "values": [null]}', "plain"),
    ('{"rule": "x", "kind": "regex", "columns": ["name"], "pattern": "("}', "pattern"), ('{"rule": "x", "kind": "regex", "columns": ["id"], "pattern": "a"}', "no text"),
    ('{"rule": "x", "kind": "row", "condition": "1 = 1"}', "condition"), ('{"rule": "x", "kind": "row"}', "condition"),
    ('{"rule": "x", "kind": "row", "condition": {"left": {"column": "id"}, "op": "like", "right": {"value": 1}}}', "like"),
    ('{"rule": "x", "kind": "row", "condition": {"left": {"column": "id"}, "op": "<", "right": {"column": "name"}}}', "compared"),
    ('{"rule": "x", "kind": "row", "condition": {"left": "id", "op": "<", "right": {"value": 1}}}', "term"),
    ('{"rule": "x", "kind": "row", "condition": ' + '{"not": ' * 80 + '{"is_null": "id"}' + "}" * 80 + "}", "condition"),
    ('{"rule": "named", "kind": "not_null", "columns": ["id"]}', "line 2"),
])
def test_a_bad_rule_names_its_line(table, line, says):
    with pytest.raises(RuleError, match=r"^line 3: ") as e:
        compile_rules(["", json.dumps(RULES[1]), line], table.schema)
    assert says in str(e.value)


def test_other_files_are_refused(spark, table, tmp_path):
    (tmp_path / "a.jsonl").write_text(json.dumps(RULES[0]))
    (tmp_path / "b.jsonl").write_text("\n" + json.dumps({"rule": "x", "kind": "nothing"}))
    with pytest.raises(RuleError, match="b.jsonl line 2"):
        read_rules(spark, str(tmp_path), table.schema)
    (tmp_path / "b.jsonl").write_text(json.dumps(RULES[0]))
    with pytest.raises(RuleError, match="same name"):
        read_rules(spark, str(tmp_path), table.schema)
    (tmp_path / "b.jsonl").write_text("#" * (MOST_BYTES + 1))
    with pytest.raises(RuleError, match="no rule file"):
        read_rules(spark, str(tmp_path), table.schema)
