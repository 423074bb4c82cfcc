"""Incremental audits (R3, Q3): a table's rules checked by reading what is new.

Not-null and range counts of a batch are the same whatever table it joins, so a table's counts are
the sum of its batches'. A row repeats a key newly only if its key is in the batch, so of the table
only the batch's keys are looked up. What each published batch counted is kept in a small table; a
batch without such a record (loaded without rules, compacted, or under other rules) is counted once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from millrace.functions.casts import col
from millrace.operators import joins, quality
from millrace.operators.joins import key_bytes, range_of_keys, within_range
from millrace.plans import ledger
from millrace.plans.warehouse import Batch, Warehouse

AUDIT = "etl_audit"
# ``covers`` names the batches that a unique rule's count is of; a row rule counts its batch alone.
AUDIT_SCHEMA = "table_name string, batch string, rules string, position int, bad_rows bigint, total_rows bigint, covers string"


def _digest(*parts: object) -> str:
    return hashlib.sha256(repr(parts).encode()).hexdigest()[:32]


def rules_digest(rules: quality.TableRules) -> str:
    """A name for what is checked; counts made under other rules do not add up with these."""
    return _digest(sorted(rules.schema.items()), rules.rules)


def covers_digest(batches: Sequence[str]) -> str:
    return _digest(*sorted(batches))


class TableAudit:
    """The audit of a batch against the table it would join: ``report`` first, ``record`` once published."""

    def __init__(self, wh: Warehouse, table: str, rules: quality.TableRules, batch: Batch, scope: str = "table"):
        self.wh, self.table, self.rules, self.batch = wh, table, rules, batch
        self.name = batch.path.rsplit("/", 1)[1]
        self.digest = rules_digest(rules)
        self.kept = [b for b in wh.batches(table) if b not in batch.replaces] if scope == "table" else []
        self.scope = scope
        # A batch of which some files are gone is another one, with counts of its own.
        gone = wh.gone_files(table, batch.replaces)
        self.known_as = {b: f"{b}~{_digest(*sorted(gone[b]))}" if b in gone else b for b in self.kept}
        self.new: list[tuple] = []

    def _records(self) -> dict[tuple[str, int], Row]:
        """One row per batch and rule, the last written of each."""
        if not self.kept or not self.wh.exists(AUDIT):
            return {}
        own = self.wh.table(AUDIT).filter((F.col("table_name") == self.table) & (F.col("rules") == self.digest))
        return {(r["batch"], r["position"]): r for r in own.collect()}

    def _row_counts(self, batches: Sequence[str]) -> dict[str, Row]:
        """Row rules of some batches: one scan of the checked columns, one row per batch back."""
        rows = self.wh.table(self.table, batches, self.batch.replaces).withColumn("_batch", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
        counted = {r["_batch"]: r for r in rows.groupBy("_batch").agg(*quality.row_counts(rows, self.rules)).collect()}
        zero = {"_total": 0, **{f"_bad{i}": 0 for i, _ in enumerate(self.rules.rules)}}
        return {b: counted.get(b, zero) for b in batches}  # an empty batch has no row

    def report(self) -> list[Row]:
        """One row per rule, as ``quality.report`` gives it for the whole table."""
        row_rules = [i for i, r in enumerate(self.rules.rules) if r.kind != "unique"]
        known = self._records()
        counts = self.batch.counters
        bad = {i: counts[f"_bad{i}"] for i in row_rules}
        total = counts["_total"]
        self._note(self.name, counts, row_rules)
        # Totals stand under position -1, also where there are no row rules.
        missing = [b for b in self.kept if any((self.known_as[b], i) not in known for i in (-1, *row_rules))]
        found = self._row_counts(missing) if missing else {}
        for b in self.kept:
            if b in found:
                self._note(self.known_as[b], found[b], row_rules)
            for i in row_rules:
                bad[i] += found[b][f"_bad{i}"] if b in found else known[self.known_as[b], i]["bad_rows"]
            total += found[b]["_total"] if b in found else known[self.known_as[b], -1]["total_rows"]
        written = self.wh.read_batch(self.batch)
        for i, rule in enumerate(self.rules.rules):
            if rule.kind == "unique":
                bad[i] = self._repeats(i, rule, written, known)
                covers = covers_digest([*self.known_as.values(), self.name]) if self.scope == "table" else ""
                self.new.append((self.table, self.name, self.digest, i, bad[i], total, covers))
        make = Row("table_name", "rule", "bad_rows", "total_rows", "passed")
        ordered = [*row_rules, *[i for i in range(len(self.rules.rules)) if i not in row_rules]]
        return [make(self.table, self.rules.rules[i].label, bad[i], total, bad[i] == 0) for i in ordered]

    def _note(self, batch: str, counts, row_rules: Sequence[int]) -> None:
        total = counts["_total"]
        self.new += [(self.table, batch, self.digest, i, counts[f"_bad{i}"], total, "") for i in row_rules]
        self.new.append((self.table, batch, self.digest, -1, 0, total, ""))

    def _repeats(self, i: int, rule: quality.Rule, written: DataFrame, known: dict) -> int:
        """Rows beyond the first of each value: those of the table, and the batch's without a new value."""
        if not self.kept:
            return quality.repeats(written, self.rules, rule).first()["bad_rows"]
        covers = covers_digest(list(self.known_as.values()))
        before = next((r["bad_rows"] for (_, n), r in known.items() if n == i and r["covers"] == covers), None)
        table = self.wh.table(self.table, self.kept, self.batch.replaces)
        if before is None:  # batches went or came otherwise
            before = quality.repeats(table, self.rules, rule).first()["bad_rows"]
        return before + self.batch.counters["_total"] - new_values(written, table, self.rules, rule)

    def record(self) -> None:
        """Keep the counts; only once the batch is published, so none is kept of a batch that is not there."""
        ledger.append_rows(self.wh, AUDIT, self.new, AUDIT_SCHEMA)


def new_values(batch: DataFrame, table: DataFrame, rules: quality.TableRules, rule: quality.Rule) -> int:
    """How many distinct values of a unique rule's columns the batch has and the table has not; NULLs are equal."""
    stats = batch.agg(
        key_bytes(batch, rule.columns).alias("key_bytes"), *range_of_keys(batch, rule.columns),
        *[F.count_if(col(c).isNull()).alias(f"_null{k}") for k, c in enumerate(rule.columns)],
    ).first().asDict()
    return unseen_values(batch, table, rules, rule, stats).count()


def unseen_values(batch: DataFrame, table: DataFrame, rules: quality.TableRules, rule: quality.Rule, stats) -> DataFrame:
    """The distinct values of the batch that the table has not.

    Of the table only the rule's columns are read, within the range of the batch's values where these
    are compared as they are stored and none is NULL. Few values are broadcast, and the table is not
    exchanged; otherwise its distinct values are.
    """
    plain = [c for k, c in enumerate(rule.columns) if not rules.schema.get(c) and not stats[f"_null{k}"] and batch.schema[c].dataType == table.schema[c].dataType]
    position = {c: k for k, c in enumerate(rule.columns)}
    if plain:
        bounds = {f"_{end}{n}": stats.get(f"_{end}{position[c]}") for n, c in enumerate(plain) for end in ("lo", "hi")}
        table = within_range(table, plain, bounds)

    def values(df: DataFrame) -> DataFrame:
        return df.select(*[quality.typed(df, rules, c)[0].alias(f"k{k}") for k, c in enumerate(rule.columns)])

    own, seen = values(batch).distinct(), values(table)
    names = [f"k{k}" for k in range(len(rule.columns))]
    if stats["key_bytes"] <= joins.BROADCAST_KEY_BYTES:
        wanted = own.withColumnsRenamed({n: f"w_{n}" for n in names})
        seen = seen.join(F.broadcast(wanted), _same(names, "w_"), "left_semi")
    seen = seen.distinct().withColumnsRenamed({n: f"s_{n}" for n in names})
    return own.join(seen, _same(names, "s_"), "left_anti")


def _same(names: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(prefix + n)) for n in names])
