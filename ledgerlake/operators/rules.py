"""Quality rules from a file: JSON lines, checked against a closed grammar and compiled to columns.

A line is one object::

    {"rule": NAME, "kind": "not_null" | "unique", "columns": [COLUMN, ...]}
    {"rule": NAME, "kind": "range", "columns": [COLUMN], "low": VALUE, "high": VALUE}     either bound may be left out
    {"rule": NAME, "kind": "set", "columns": [COLUMN], "values": [VALUE, ...]}
    {"rule": NAME, "kind": "regex", "columns": [COLUMN], "pattern": TEXT}
    {"rule": NAME, "kind": "row", "condition": CONDITION}

with an optional ``"threshold"`` from 0 to 1. A condition is ``{"all": [CONDITION, ...]}``, ``{"any": [...]}``, ``{"not": CONDITION}``,
``{"is_null": COLUMN}`` or a comparison ``{"left": TERM, "op": "=" | "<>" | "<" | "<=" | ">" | ">=", "right": TERM}``, and a term
``{"column": COLUMN}`` or ``{"value": VALUE}``. Nothing in a rule is ever taken for SQL. Blank lines and lines that begin with ``#`` are left out.
"""

from __future__ import annotations

import json
import operator
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.gates import Rule, dq_scan

MOST_BYTES = 4 << 20  # a longer file is no rule file
MOST_DEPTH = 50
# Keys of a rule by kind, and comparison operators.
FIELDS = {"not_null": (), "unique": (), "range": ("low", "high"), "set": ("values",), "regex": ("pattern",), "row": ("condition",)}
COMPARISONS = {"=": operator.eq, "<>": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}
_NUMBERS = (T.NumericType,)


class RuleError(ValueError):
    """A rule that the grammar or the table does not allow; says in which line it stands."""


def _kind(kind: T.DataType) -> str:
    if isinstance(kind, _NUMBERS):
        return "number"
    if isinstance(kind, (T.StringType, T.BooleanType)):
        return "text" if isinstance(kind, T.StringType) else "boolean"
    return "time" if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else "other"


class _Line:
    """Checks and compiles one line against a table's columns."""

    def __init__(self, place: str, schema: T.StructType):
        self.place, self.columns = place, {f.name: f.dataType for f in schema.fields}

    def need(self, ok: bool, message: str) -> None:
        if not ok:
            raise RuleError(f"{self.place}: {message}")

    def column(self, name: object) -> Column:
        self.need(isinstance(name, str) and name in self.columns, f"no column {name!r}")
        return F.col("`" + name.replace("`", "``") + "`")

    def value(self, value: object, kind: T.DataType | None) -> Column:
        """A literal; with ``kind`` it must be comparable with a column of that type."""
        self.need(isinstance(value, (str, int, float, bool)), f"no plain value: {value!r}")
        mine = "boolean" if isinstance(value, bool) else "text" if isinstance(value, str) else "number"
        if kind is None:
            return F.lit(value)
        want = _kind(kind)
        self.need(want == mine or (want == "time" and mine == "text"), f"{value!r} cannot be compared with a column of type {kind.simpleString()}")
        if want != "time":
            return F.lit(value)
        self.need(bool(re.fullmatch(r"\d{4}-\d\d-\d\d([ T]\d\d:\d\d:\d\d(\.\d{1,6})?)?", value)), f"no date or timestamp: {value!r}")
        return F.lit(value).try_cast(kind.simpleString())

    def condition(self, c: object, depth: int = 0) -> Column:
        self.need(isinstance(c, Mapping) and depth <= MOST_DEPTH, f"no condition: {c!r}")
        keys = set(c)
        if keys in ({"all"}, {"any"}):
            (name,) = keys
            self.need(isinstance(c[name], list) and bool(c[name]), f"{name} needs a list of conditions")
            parts = [self.condition(x, depth + 1) for x in c[name]]
            out = parts[0]
            for p in parts[1:]:
                out = out & p if name == "all" else out | p
            return out
        if keys == {"not"}:
            return ~self.condition(c["not"], depth + 1)
        if keys == {"is_null"}:
            return self.column(c["is_null"]).isNull()
        self.need(keys == {"left", "op", "right"}, f"no condition: {dict(c)!r}")
        self.need(isinstance(c["op"], str) and c["op"] in COMPARISONS, f"no comparison: {c['op']!r}")
        kinds = [self._type_of(c[side]) for side in ("left", "right")]
        if None not in kinds:
            self.need(_kind(kinds[0]) == _kind(kinds[1]) != "other", f"{c['left']!r} and {c['right']!r} cannot be compared")
        left, right = (self._term(c[side], kinds[1 - k]) for k, side in enumerate(("left", "right")))
        return COMPARISONS[c["op"]](left, right)

    def _type_of(self, term: object) -> T.DataType | None:
        self.need(isinstance(term, Mapping) and set(term) in ({"column"}, {"value"}), f"no term: {term!r}")
        if "value" in term:
            return None
        self.column(term["column"])
        return self.columns[term["column"]]

    def _term(self, term: Mapping, other: T.DataType | None) -> Column:
        return self.column(term["column"]) if "column" in term else self.value(term["value"], other)

    def rule(self, given: object) -> Rule:
        self.need(isinstance(given, Mapping), "a rule is an object")
        name, kind = given.get("rule"), given.get("kind")
        self.need(isinstance(name, str) and bool(name), "a rule needs a name")
        self.need(isinstance(kind, str) and kind in FIELDS, f"no kind of rule: {kind!r}")
        own = {"rule", "kind", "threshold", *FIELDS[kind], *(() if kind == "row" else ("columns",))}
        self.need(set(given) <= own, f"unknown keys: {sorted(set(given) - own)}")
        threshold = given.get("threshold", 1.0)
        self.need(isinstance(threshold, (int, float)) and not isinstance(threshold, bool) and 0 <= threshold <= 1, f"no threshold: {threshold!r}")
        if kind == "row":
            self.need("condition" in given, "a row rule needs a condition")
            return Rule(name, kind, (), (self.condition(given["condition"]),), float(threshold))
        columns = given.get("columns")
        self.need(isinstance(columns, list) and bool(columns), "a rule needs columns")
        for c in columns:
            self.column(c)
        self.need(kind == "unique" or len(columns) == 1, f"{kind} takes one column")
        args: tuple = ()
        if kind == "range":
            self.need(any(given.get(k) is not None for k in ("low", "high")), "a range needs a bound")
            args = tuple(None if given.get(k) is None else self.value(given[k], self.columns[columns[0]]) for k in ("low", "high"))
        elif kind == "set":
            self.need(isinstance(given.get("values"), list) and bool(given["values"]), "a set needs values")
            args = tuple(self.value(v, self.columns[columns[0]]) for v in given["values"])
        elif kind == "regex":
            self.need(isinstance(given.get("pattern"), str), "a regex needs a pattern")
            self.need(_kind(self.columns[columns[0]]) == "text", f"{columns[0]} is no text")
            try:
                re.compile(given["pattern"])
            except re.error as e:
                self.need(False, f"no pattern: {e}")
            args = (given["pattern"],)
        return Rule(name, kind, tuple(columns), args, float(threshold))


def compile_rules(lines: Sequence[str], schema: T.StructType, place: str = "line") -> list[Rule]:
    """Rules of JSON lines for a table of that schema. The first line that is not allowed is an error that names it."""
    rules: list[Rule] = []
    seen: dict[str, int] = {}
    for number, text in enumerate(lines, 1):
        if not text.strip() or text.lstrip().startswith("#"):
            continue
        line = _Line(f"{place} {number}", schema)
        try:
            given = json.loads(text)
        except (ValueError, RecursionError) as e:
            raise RuleError(f"{line.place}: no JSON: {e}") from e
        rule = line.rule(given)
        line.need(rule.name not in seen, f"rule {rule.name!r} stands in line {seen.get(rule.name)} already")
        seen[rule.name] = number
        rules.append(rule)
    return rules


def read_rules(spark: SparkSession, path: str, schema: T.StructType) -> list[Rule]:
    """Rules of a file or of the files of a folder, in order of their names."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    size = files.agg(F.sum("length")).first()[0] or 0
    if size > MOST_BYTES:
        raise RuleError(f"{path}: {size} bytes are no rule file")
    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value").orderBy("path").collect()
    rules = [r for t in texts for r in compile_rules(t.value.split("\n"), schema, f"{t.path} line")]
    names = [r.name for r in rules]
    if len(set(names)) < len(names):
        raise RuleError(f"{path}: rules of the same name: {sorted({n for n in names if names.count(n) > 1})}")
    return rules


def scan_with_file(df: DataFrame, path: str, by: Sequence[str] = ()) -> DataFrame:
    """``dq_scan`` of a table by the rules of a file."""
    return dq_scan(df, read_rules(df.sparkSession, path, df.schema), by)
