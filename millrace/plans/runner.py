"""Runs (R3, R4): every source goes through extract, transform, load, audit, publish, record."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import InheritableThread

from millrace.functions.times import utc_now
from millrace.operators import quality
from millrace.operators.project import postprocess
from millrace.plans import ledger
from millrace.plans.audit import TableAudit
from millrace.plans.export import export_table
from millrace.plans.load import finish, prepare
from millrace.plans.spec import SourceSpec, group_sources
from millrace.plans.warehouse import Warehouse
from millrace.sources.registry import get_adapter
from millrace.sources.windows import mark_of, past

# Sources that are cheap to read again; a batch of any other is staged once as Parquet.
_COLUMNAR = ("parquet",)


@dataclass
class SourceResult:
    source: SourceSpec
    ok: bool = True
    rows: int = 0
    rows_table: int | None = None
    counters: dict = field(default_factory=dict)
    report: list = field(default_factory=list)  # one row per quality rule
    verdict: quality.Verdict = quality.Verdict(True, 0, "warn")
    decision: str = "pass"
    since: str | None = None
    error: str | None = None
    seconds: float = 0.0
    loaded_at: datetime = field(default_factory=utc_now)


@dataclass
class RunResult:
    run_id: str
    status: str
    error: str | None
    results: list[SourceResult]


def run_source(
    wh: Warehouse, source: SourceSpec, dq: Mapping | None, as_of: datetime, fail_fast: bool = False
) -> SourceResult:
    """One source. The batch is written, audited, and only then published."""
    out = SourceResult(source)
    df = postprocess(get_adapter(source.type)(wh.spark, source.params, as_of), source.post)
    since = mark = staged = None
    marked = source.since_field is not None and source.since_field in df.columns
    if marked:
        since = source.since_value or ledger.stored_since(wh, source.name)
        df = past(df, source.since_field, since)
        staged = wh.stage(f"{source.name}_since", df, lambda d: [mark_of(source.since_field).alias("since")])
        mark = staged.counters["since"]
        df = wh.read_batch(staged)

    rules = quality.rules_for(dq, source.table)
    batch = None
    try:
        batch = prepare(
            wh, source.table, df, source.mode, keys=source.keys, cast_map=source.cast_map,
            order_by=source.order_by or None, dedupe_batch=source.dedupe_batch,
            metrics=(lambda d: quality.row_counts(d, rules)) if rules else None,
            stage=staged is None and source.type not in _COLUMNAR,
        )
        audit = None
        if rules:
            # The rules hold for the table as it would be; of it only what is new is read.
            audit = TableAudit(wh, source.table, rules, batch, source.dq_scope)
            out.report = audit.report()
            out.verdict = quality.verdict_of(out.report, rules)
        out.decision = quality.gate(out.verdict, fail_fast)
        blocked = not out.verdict.passed and out.verdict.on_fail == "block"
        if not blocked:
            finish(wh, batch)
            if audit and batch.published:
                audit.record()
            if mark is not None:
                ledger.append_rows(wh, ledger.STATE, [(source.name, mark, utc_now())], ledger.STATE_SCHEMA)
    finally:
        for written in (staged, batch):
            if written is not None and not written.published:
                wh.discard(written)
    if source.export and not blocked:
        export_table(wh, source.table, source.export, batch if batch.published else None)
    out.since = mark or since
    out.rows = 0 if blocked else batch.counters.get("inserted", batch.counters.get("rows_batch", batch.rows))
    if batch.published and source.mode == "replace":
        out.rows_table = batch.rows
    else:
        out.rows_table = wh.table(source.table).count() if wh.exists(source.table) else 0
    out.counters = batch.counters
    return out


def run_micro_batch(wh: Warehouse, source: SourceSpec, rows: DataFrame, dq: Mapping | None, tag: str) -> None:
    """A micro-batch as a run of one source: written, audited, recorded, published or blocked, exported.

    Everything it leaves is named by ``tag``, so a micro-batch that is run again after a failure, at
    whatever step that was, is loaded once and has one metrics row and one run row; the run row comes
    last. An export is written again, which changes nothing.
    """
    if wh.has_batch(ledger.RUNS, tag):
        return
    started, out, batch = utc_now(), SourceResult(source), None
    clock = time.monotonic()
    rules = quality.rules_for(dq, source.table)
    run_id = f"stream_{tag}"
    if not wh.has_batch(source.table, tag):
        try:
            batch = prepare(
                wh, source.table, rows, source.mode, keys=source.keys, cast_map=source.cast_map,
                order_by=source.order_by or None, dedupe_batch=source.dedupe_batch, tag=tag,
                metrics=(lambda d: quality.row_counts(d, rules)) if rules else None,
            )
            audit = TableAudit(wh, source.table, rules, batch, source.dq_scope) if rules else None
            if audit:
                out.report = audit.report()
                out.verdict = quality.verdict_of(out.report, rules)
            out.decision = quality.gate(out.verdict)
            blocked = out.decision == "block"
            out.rows = 0 if blocked else batch.counters.get("inserted", batch.counters.get("rows_batch", batch.rows))
            out.rows_table = (wh.table(source.table).count() if wh.exists(source.table) else 0) + (0 if blocked else batch.rows)
            out.seconds, out.loaded_at = time.monotonic() - clock, utc_now()
            _record_sources(wh, run_id, [out], tag)
            if not blocked:
                finish(wh, batch)
                if audit and batch.published:
                    audit.record()
        finally:
            if batch is not None and not batch.published:
                wh.discard(batch)
    if source.export and wh.exists(source.table) and out.decision != "block":
        export_table(wh, source.table, source.export, batch if batch is not None and batch.published else None)
    loaded = ledger.metrics(wh).filter(F.col("run_id") == run_id).agg(F.sum("rows_loaded").alias("n")).first()["n"]
    finished = utc_now()
    run = (run_id, started, finished, f"stream {source.name}", "ok", None, 1, loaded, (finished - started).total_seconds())
    ledger.append_rows(wh, ledger.RUNS, [run], ledger.RUNS_SCHEMA, tag)
    ledger.tidy(wh)


def _attempt(wh: Warehouse, source: SourceSpec, dq, as_of: datetime, fail_fast: bool = False) -> SourceResult:
    """A failed source is a result, not a crash of the run."""
    started = time.monotonic()
    try:
        result = run_source(wh, source, dq, as_of, fail_fast)
    except Exception as e:
        result = SourceResult(source, ok=False, error=str(e))
    result.seconds, result.loaded_at = time.monotonic() - started, utc_now()
    return result


def run_group(
    spark: SparkSession,
    warehouse: Warehouse,
    config: Mapping,
    dq: Mapping | None,
    group: str,
    fail_fast: bool = False,
    as_of: datetime | None = None,
) -> RunResult:
    """The sources of a group in order; an error, or a failed audit under ``fail_fast``, ends it."""
    started, sources = utc_now(), group_sources(config, group)
    results, status = [], "ok"
    for source in sources:
        result = _attempt(warehouse, source, dq, as_of or started, fail_fast)
        results.append(result)
        if not result.ok or result.decision == "stop":
            status = "fail"
            break
    return _record(warehouse, group, started, status, len(sources), results)


def run_sources(
    warehouse: Warehouse,
    sources: Sequence[Mapping],
    dq: Mapping | None = None,
    as_of: datetime | None = None,
    parallel: int = 4,
) -> RunResult:
    """Independent sources; an error is recorded and the others go on.

    Sources of different tables may run side by side, so that small ones do not wait for each
    other on a large cluster; those of one table run in their order. Each has a pool of the fair
    scheduler (``spark.scheduler.mode``, which ``build_session`` sets), so a large one does not starve
    the others, and a tag, by which its jobs are cancelled once it passes its ``time_limit_seconds``;
    that is recorded like any error.
    """
    started = utc_now()
    specs = [SourceSpec.from_dict(s) for s in sources]
    by_table: dict[str, list[SourceSpec]] = {}
    for spec in specs:
        by_table.setdefault(spec.table, []).append(spec)

    def in_order(members: list[SourceSpec]) -> list[SourceResult]:
        done = []
        for spec in members:
            with _isolated(warehouse.spark, spec) as limit:
                done.append(_attempt(warehouse, spec, dq, as_of or started))
            if limit.passed and not done[-1].ok:
                done[-1].error = f"cancelled after {spec.time_limit_seconds} s: {done[-1].error}"
        return done

    with ThreadPoolExecutor(max_workers=max(parallel, 1)) as pool:
        done = {id(r.source): r for part in pool.map(in_order, by_table.values()) for r in part}
    results = [done[id(spec)] for spec in specs]
    status = "ok" if all(r.ok for r in results) else "fail"
    return _record(warehouse, "all", started, status, len(specs), results)


class _Limit:
    """Cancels the jobs of a tag, those that start later too, from a moment on."""

    def __init__(self, spark: SparkSession, tag: str, seconds: float | None):
        self.spark, self.tag, self.seconds = spark, tag, seconds
        self.passed, self.over = False, threading.Event()

    def watch(self) -> None:
        wait = self.seconds
        while not self.over.wait(wait):
            self.passed, wait = True, 0.2
            self.spark.sparkContext.cancelJobsWithTag(self.tag)


@contextmanager
def _isolated(spark: SparkSession, source: SourceSpec):
    """A pool and a tag for the jobs that this thread starts."""
    sc, tag = spark.sparkContext, f"millrace-{uuid.uuid4().hex}"
    limit = _Limit(spark, tag, source.time_limit_seconds)
    watcher = InheritableThread(target=limit.watch, daemon=True) if source.time_limit_seconds else None
    sc.setLocalProperty("spark.scheduler.pool", f"millrace-{source.name}")
    sc.addJobTag(tag)
    try:
        if watcher:
            watcher.start()
        yield limit
    finally:
        limit.over.set()
        if watcher:
            watcher.join()
        sc.removeJobTag(tag)
        sc.setLocalProperty("spark.scheduler.pool", None)


def _record(
    wh: Warehouse, group: str, started: datetime, status: str, n_sources: int, results: list[SourceResult]
) -> RunResult:
    """A metrics row per source, also for one that ended the run, and one row for the run."""
    run_id, finished = ledger.new_run_id(started), utc_now()
    error = next((r.error for r in results if r.error), None)
    run = (
        run_id, started, finished, group, status, error, n_sources, sum(r.rows for r in results),
        (finished - started).total_seconds(),
    )
    _record_sources(wh, run_id, results)
    ledger.append_rows(wh, ledger.RUNS, [run], ledger.RUNS_SCHEMA)
    return RunResult(run_id, status, error, results)


def _record_sources(wh: Warehouse, run_id: str, results: list[SourceResult], tag: str | None = None) -> None:
    metrics = [
        (
            run_id, r.source.name, r.source.table, r.rows, r.seconds, r.verdict.passed if r.ok else None,
            r.verdict.violations, r.loaded_at, r.rows_table, r.source.mode, r.ok, r.error, r.source.since_field, r.since,
        )
        for r in results
    ]
    rules = [(run_id, *row) for r in results for row in r.report]
    ledger.append_rows(wh, ledger.METRICS, metrics, ledger.METRICS_SCHEMA, tag)
    ledger.append_rows(wh, ledger.DQ_REPORT, rules, ledger.DQ_REPORT_SCHEMA, tag)
