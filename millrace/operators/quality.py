"""Data quality (Q1-Q7).

All not-null and range rules of a table share one aggregation with one row of counts. A
uniqueness rule needs its own grouping; copies are counted before the exchange, so a hot value
costs one row per task. A verdict counts failed *rules*; the report also has bad rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.casts import coerce, coerce_float, col, declared


@dataclass(frozen=True)
class Rule:
    """One check of one table."""

    kind: str  # not_null | unique | range
    columns: tuple[str, ...]
    minimum: float | None = None
    maximum: float | None = None
    inclusive: bool = True

    @property
    def label(self) -> str:
        names = ",".join(self.columns)
        if self.kind != "range":
            return f"{self.kind}({names})"
        return f"range({names},{_bound(self.minimum)},{_bound(self.maximum)})"


def _bound(value: float | None) -> str:
    return "" if value is None else f"{value:g}" if abs(value) < 1e6 else f"{value:.0f}"


@dataclass(frozen=True)
class TableRules:
    """Casts, checks and the reaction configured for one table."""

    schema: Mapping[str, str]
    rules: tuple[Rule, ...]
    on_fail: str = "warn"  # warn | block


@dataclass(frozen=True)
class Verdict:
    passed: bool
    violations: int
    on_fail: str


def rules_for(dq: Mapping | None, table: str) -> TableRules | None:
    """Read the rules of one table from a ``{"rules": {table: ...}}`` block."""
    block = ((dq or {}).get("rules") or {}).get(table)
    if not block:
        return None
    rules = []
    for check in block.get("checks") or []:
        if "not_null" in check:
            rules.append(Rule("not_null", tuple(check["not_null"])))
        elif "unique" in check:
            rules.append(Rule("unique", tuple(check["unique"])))
        elif "range" in check:
            r = check["range"]
            rules.append(Rule("range", (r["column"],), r.get("min"), r.get("max"), r.get("inclusive", True)))
    return TableRules(block.get("schema") or {}, tuple(rules), block.get("on_fail", "warn"))


# The type a declared coercion gives.
_KIND_TYPES = {"int": T.LongType(), "float": T.DoubleType(), "datetime": T.TimestampType(), "str": T.StringType()}


def typed(df: DataFrame, rules: TableRules, name: str) -> tuple[Column, T.DataType]:
    """Q1: a column as the rules declare it."""
    dtype, kind = df.schema[name].dataType, rules.schema.get(name)
    type_name = declared(kind)[0]
    if type_name not in _KIND_TYPES:
        return col(name), dtype
    return coerce(col(name), dtype, kind), _KIND_TYPES[type_name]


def _need(df: DataFrame, rule: Rule) -> None:
    absent = [c for c in rule.columns if c not in df.columns]
    if absent:
        raise ValueError(f"{rule.kind} on missing column(s): {absent}")


def bad_row(df: DataFrame, rules: TableRules, rule: Rule) -> Column:
    """Whether a row breaks a not-null or range rule; NULL and NaN pass a range."""
    if rule.kind == "not_null":
        _need(df, rule)
        missing = []
        for c, dtype in (typed(df, rules, name) for name in rule.columns):
            missing.append(c.isNull() | F.isnan(c) if isinstance(dtype, (T.FloatType, T.DoubleType)) else c.isNull())
        return reduce(lambda a, b: a | b, missing)
    name = rule.columns[0]
    if name not in df.columns:
        return F.lit(False)
    x = coerce_float(*typed(df, rules, name))
    low, high = rule.minimum, rule.maximum
    bad = F.lit(False)
    if low is not None:
        bad = bad | (x < float(low) if rule.inclusive else x <= float(low))
    if high is not None:
        bad = bad | (x > float(high) if rule.inclusive else x >= float(high))
    return bad


def row_counts(df: DataFrame, rules: TableRules) -> list[Column]:
    """Q2, Q4: aggregates ``_total`` and ``_bad<i>`` for ``agg``, or for an observation of a write."""
    return [F.count(F.lit(1)).alias("_total")] + [
        F.count_if(bad_row(df, rules, rule)).alias(f"_bad{i}")
        for i, rule in enumerate(rules.rules)
        if rule.kind != "unique"
    ]


def repeats(df: DataFrame, rules: TableRules, rule: Rule) -> DataFrame:
    """Q3: rows beyond the first of each value, NULLs equal: one row ``rule, bad_rows, total_rows``."""
    _need(df, rule)
    copies = df.groupBy(*[typed(df, rules, name)[0].alias(name) for name in rule.columns]).agg(
        F.count(F.lit(1)).alias("n")
    )
    return copies.agg(
        F.lit(rule.label).alias("rule"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("bad_rows"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_rows"),
    )


def report(df: DataFrame, table: str, rules: TableRules, counted: Mapping | None = None) -> DataFrame:
    """Q6: ``table_name, rule, bad_rows, total_rows, passed``, one row per rule; lazy.

    Not-null and range rules come from one scan of the checked columns, or from ``counted``, the
    ``row_counts`` observed while the rows were written, and then need no scan at all.
    """
    parts = []
    row_rules = [(i, r) for i, r in enumerate(rules.rules) if r.kind != "unique"]
    if row_rules:
        if counted is None:
            counts = df.agg(*row_counts(df, rules))
        else:
            names = ["_total", *[f"_bad{i}" for i, _ in row_rules]]
            one = df.sparkSession.range(1, numPartitions=1)
            counts = one.select(*[F.lit(counted[n]).cast("bigint").alias(n) for n in names])
        rows = [
            F.struct(F.lit(r.label).alias("rule"), F.col(f"_bad{i}").alias("bad_rows"), F.col("_total").alias("total_rows"))
            for i, r in row_rules
        ]
        parts.append(counts.select(F.inline(F.array(*rows))))
    parts += [repeats(df, rules, r) for r in rules.rules if r.kind == "unique"]
    if not parts:
        none = df.sparkSession.createDataFrame([], "rule string, bad_rows bigint, total_rows bigint")
        parts.append(none)
    return reduce(DataFrame.unionByName, parts).select(
        F.lit(table).alias("table_name"), "rule", "bad_rows", "total_rows", (F.col("bad_rows") == 0).alias("passed")
    )


def verdict_frame(report_df: DataFrame, table: str, on_fail: str = "warn") -> DataFrame:
    """Q5: ``table_name, violations, passed, on_fail``; violations are failed rules."""
    return report_df.agg(F.count_if(~F.col("passed")).alias("violations")).select(
        F.lit(table).alias("table_name"),
        "violations",
        (F.col("violations") == 0).alias("passed"),
        F.lit(on_fail).alias("on_fail"),
    )


def verdict_of(report_rows: Sequence[Row], rules: TableRules) -> Verdict:
    """Q5 from the collected report, one row per rule."""
    failed = sum(not row["passed"] for row in report_rows)
    return Verdict(failed == 0, failed, rules.on_fail)


def check(df: DataFrame, table: str, dq: Mapping | None) -> Verdict:
    """Q1-Q5 for one frame; a table without rules passes."""
    rules = rules_for(dq, table)
    if rules is None:
        return Verdict(True, 0, "warn")
    return verdict_of(report(df, table, rules).collect(), rules)


def gate(v: Verdict, fail_fast: bool = False) -> str:
    """Q7: ``pass``, ``warn`` (record, go on), ``block`` (do not publish), ``stop`` (end the group)."""
    if v.passed:
        return "pass"
    if fail_fast:
        return "stop"
    return "block" if v.on_fail == "block" else "warn"

